import re

import pytest

from leadrank.llm import secrets


def brute(text):
    """Findings by the patterns as they stand, match by match."""
    out = []
    for order, (kind, pattern, group, least) in enumerate(secrets.KINDS):
        if kind == "assign":
            pattern = re.sub(r"[a-z]{3,}|_key", lambda m: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in m.group()), pattern.split(")")[0]) + pattern[pattern.index(")") :]
        for m in re.finditer(pattern, text or ""):
            if len(m.group(group)) >= least:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


KEY = "AKIA" + "Q7" * 8
CASES = [
    f"Password = 'abcDEF123456' and {KEY}.",
    "token: token = abcdefghijkl",
    "secret=secret=abcdefghijklmnop",
    "passwd:short api_key=\"0123456789abcdef0123\"",
    f"{KEY}{KEY} AKIA123 akia{'0' * 20}",
    "deadbeef" * 2 + " " + "deadbee" * 2 + "é " + "0123456789abcdef" * 3,
    "😀😀 apikey:0123456789abcdef",
    "ſecret=abcdefghijkl toKen=abcdefghijkl",
    "x" * 50_000 + " token=abcdefghijklmn",
]


def results(found):
    return sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.spans) for r in found.collect()), key=str)


def want(rows):
    counted = [(i, brute(t)) for i, t in rows]
    return sorted(((i, *(s.count(k) for k in ("assign:", "access:", "hex:")), s) for i, s in counted), key=str)


@pytest.fixture
def ledger(tmp_path):
    return str(tmp_path / "ledger")


def test_spans(docs_of, odd_texts, ledger):
    rows = list(enumerate(CASES + odd_texts)) + [(2, CASES[0]), (2, CASES[0]), (None, CASES[0]), (None, CASES[1]), (None, None)]
    assert results(secrets.scan_versions(docs_of(rows), ledger, path="doc_id")) == want(rows)


def test_only_unseen_pairs_are_scanned(spark, docs_of, ledger):
    first = [(1, CASES[0]), (2, CASES[0]), (3, CASES[1])]
    secrets.scan_versions(docs_of(first), ledger, path="doc_id").collect()
    assert spark.read.parquet(ledger).count() == 2
    second = [*first, (1, CASES[2]), (4, CASES[0])]
    assert results(secrets.scan_versions(docs_of(second), ledger, path="doc_id")) == want(second)
    assert spark.read.parquet(ledger).count() == 3
    assert results(secrets.scan_versions(docs_of(second), ledger, path="doc_id", rule_version="base-2")) == want(second)
    assert spark.read.parquet(ledger).groupBy("rule_version").count().count() == 2
    assert spark.read.parquet(ledger).count() == 6


def test_two_writers_of_one_blob(spark, docs_of, ledger):
    rows = [(1, CASES[0]), (2, CASES[0]), (3, CASES[1])]
    secrets.scan_versions(docs_of(rows), ledger, path="doc_id").collect()
    held = spark.createDataFrame(spark.read.parquet(ledger).collect(), secrets.LEDGER)
    held.write.mode("append").parquet(ledger)
    assert results(secrets.scan_versions(docs_of(rows), ledger, path="doc_id")) == want(rows)


def test_query(spark, sf):
    import hashlib

    from leadrank.llm.queries import all_queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = all_queries()["op6_secrets"](spark, sf).collect()
    assert sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.spans) for r in found), key=str) == want(rows)
    assert all(r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest() for r in found)


def test_empty_table(docs_of, ledger):
    assert secrets.scan_versions(docs_of([]), ledger, path="doc_id").collect() == []


def test_redaction():
    assert secrets.redact([CASES[0], None, "a"], [brute(CASES[0]), "", None]) == ["[secret]' and [secret].", None, "a"]
    assert secrets.redact(["0123456789"], ["assign:1:5,hex:3:7"]) == ["0[secret]789"]
