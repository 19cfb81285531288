"""Queries that run Python on the workers, where these cannot import the package."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
NAMES = [
    "a5_cached_clusters", "c2_phrase_counts", "c5_token_norm", "c6_tf", "c7_idf", "c9_firm_scores", "c15_page_text", "c16_site_text",
    "d1_latent_embed", "d6_cosine", "e1_phrase_grid", "f2_soft_tfidf", "f6_best_sector", "g1_kmeans", "g2_assign", "g3_silhouette_exact",
    "g3_silhouette_squared", "l2_latent_rank", "l2_text_rank", "l5_site_rank", "s1_form_sheet",
]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from leadrank import queries
from leadrank.operators import clusters
from leadrank.session import local_session

spark = local_session(4, "without-the-package")

def importable(batches):
    import pyarrow as pa
    try:
        import leadrank
        found = True
    except ImportError:
        found = False
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([found] * b.num_rows)], names=["found"])

assert [r.found for r in spark.range(1).mapInArrow(importable, "found boolean").collect()] == [False]
for name in {names!r}:
    queries.all_queries()[name](spark, {sf!r}).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
vectors = queries.X.vectors(spark, {sf!r})
print("ran", clusters.k_sweep(vectors, "vec_id", "vec", [2, 5], exact=True).count())
print("ran", clusters.k_sweep(vectors, "vec_id", "vec", [2, 5]).count())
"""


def test_workers_without_the_package(sf, tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(ROOT), sf=sf, names=NAMES))
    path = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p and Path(p).resolve() != ROOT]
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ":".join(path)}, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") == len(NAMES) + 2
