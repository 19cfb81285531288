"""One query per operator over the test tables.

Computed numbers are rounded to six digits so that engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadrank import fixtures as X
from leadrank.functions import text as T
from leadrank.functions import vectors as V
from leadrank.functions.contacts import FIELDS, SLOTS, slot_column, title_rank
from leadrank.operators import clusters, contacts, embedding, latent, messages, phrases, prompts, ranking, sites
from leadrank.operators.rows import inlined
from leadrank.operators.similarity import Dense, HashedText, similarity_rows, soft_idf_table, soft_scores
from leadrank.plans import clustering, leads, relevance
from leadrank.session import scratch_path
from leadrank.sources import form_sheet, keywords, tables, vector_cache
from leadrank.streaming import requests

DENSE = Dense("vec")
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(value) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    # Adding zero turns -0.0 into 0.0.
    return F.round(value, 6) + F.lit(0.0)


def round_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[rounded(c).alias(c) if c in names else F.col(c) for c in df.columns])


SCORES = ("keyword_score", "sector_score", "score")


# Sources and sinks


@query
def a1_a2_csv_round_trip(spark, sf):
    docs = X.companies(spark, sf)
    path = scratch_path(spark, "companies-csv")
    tables.write_csv(docs, path)
    return tables.read_csv(spark, path, docs.schema)


@query
def a2_ranked_round_trip(spark, sf):
    rows = X.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    path = scratch_path(spark, "ranked")
    tables.write_ranked(ranking.ranked(rows, ranking.best_first("c_acctbal", "c_custkey")), path)
    return tables.read_parquet(spark, path, ["c_custkey", "rank"])


@query
def a3_keywords(spark, sf):
    return keywords.parse_keywords(X.keyword_objects(spark, sf), "set_id", "json")


@query
def a5_vector_cache_miss(spark, sf):
    cached = X.labelled_companies(spark, sf).select(vector_cache.text_key(F.col("text")).alias("key")).distinct()
    missing = vector_cache.missing_texts(X.companies(spark, sf), "Description", cached)
    return missing.select("key", F.length("text").cast("bigint").alias("chars"))


# Company table


@query
def b1_suffix_clean(spark, sf):
    docs = X.companies(spark, sf).select(
        "company_id", F.col("lang").alias("lang_x"), F.upper("lang").alias("lang_y"), F.col("source").alias("source_x")
    )
    return contacts.drop_merge_leftovers(docs)


@query
def b2_drop_null(spark, sf):
    labels = X.table(spark, sf, "labels").select(F.col("doc_id").alias("company_id"), "quality")
    joined = X.companies(spark, sf).join(labels, "company_id", "left")
    described = joined.withColumn("Description", F.when(F.col("quality").isNotNull(), F.col("Description")))
    return contacts.drop_missing(described, "Description").select("company_id", "Description")


@query
def b3_unpack(spark, sf):
    return contacts.unpack_contacts(X.contacts(spark, sf), "company_id")


@query
def b4_email_ok(spark, sf):
    people = X.contacts(spark, sf).select("company_id", F.filter(contacts.people_array(), contacts.plausible).alias("p"))
    return inlined(people, ["company_id"], F.col("p"), ["slot", *FIELDS])


@query
def b5_title_rank(spark, sf):
    people = contacts.unpack_contacts(X.contacts(spark, sf), "company_id")
    return people.select("company_id", "slot", "title", title_rank(F.col("title")).alias("title_rank"))


@query
def b6_compact(spark, sf):
    return contacts.compact_contacts(X.contacts(spark, sf))


@query
def b7_reachable(spark, sf):
    return contacts.reachable(contacts.compact_contacts(X.contacts(spark, sf))).select(
        "company_id", F.col(f"`{slot_column('email', 1)}`").alias("email_1")
    )


@query
def b8_min_tokens(spark, sf):
    words = T.word_count(F.col("Description"))
    return X.companies(spark, sf).select("company_id", words.alias("words")).where(F.col("words") >= 20)


@query
def b9_contacts_clean(spark, sf):
    raw = X.table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", F.lit("  "))
        .otherwise(F.concat(F.lit(" u"), F.col("user_id").cast("string"), F.lit("@mail.example.com\t")))
        .alias("email")
    )
    return contacts.contact_list(raw, "email")


@query
def b10_label_sample(spark, sf):
    rows = X.labelled_companies(spark, sf).select("company_id", "starred", "prior")
    return ranking.label_sample(rows, "starred", [True, False], "company_id", 100)


# Text


@query
def c1_sentences(spark, sf):
    return embedding.sentence_rows(X.companies(spark, sf), "company_id", "Description")


@query
def c2_phrase_counts(spark, sf):
    return phrases.phrase_counts(X.companies(spark, sf), "company_id", "Description", X.phrases(spark))


@query
def c3_presence_score(spark, sf):
    scored = phrases.presence_score(X.companies(spark, sf), "company_id", "Description", X.phrases(spark))
    return scored.select("company_id", "score")


@query
def c4_density(spark, sf):
    scored = phrases.presence_score(X.companies(spark, sf), "company_id", "Description", X.phrases(spark))
    return round_columns(scored, "density")


@query
def c5_token_norm(spark, sf):
    return phrases.phrase_counts(X.companies(spark, sf), "company_id", "Description", X.phrases(spark), tokenize=True)


@query
def c6_tf(spark, sf):
    return round_columns(phrases.term_frequency(X.companies(spark, sf), "company_id", "Description", X.phrases(spark)), "tf")


@query
def c7_idf(spark, sf):
    return round_columns(phrases.containment_idf(X.companies(spark, sf), "company_id", "Description", X.phrases(spark)), "idf")


@query
def c8_tfidf(spark, sf):
    cells = phrases.tf_idf(X.companies(spark, sf), "company_id", "Description", X.phrases(spark))
    return round_columns(cells.select("company_id", "name", "tfidf"), "tfidf")


@query
def c9_firm_scores(spark, sf):
    scored = phrases.tf_idf_scores(X.companies(spark, sf), "company_id", "Description", X.phrases(spark))
    return round_columns(scored, "raw", "score")


@query
def c10_reply_tail(spark, sf):
    return X.companies(spark, sf).select("company_id", T.reply_tail(F.col("Description")).alias("tail"))


@query
def c11_founders(spark, sf):
    return prompts.founders(X.founder_replies(spark, sf), "reply_id", "reply")


def _prompt_rows(spark, sf) -> DataFrame:
    return X.table(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_name").alias("Name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("Annual revenue"),
        (F.col("c_mktsegment") == "MACHINERY").alias("Starred"),
        F.col("c_nationkey").alias("Nation"),
    )


PROMPT_COLUMNS = ["Name", "Annual revenue", "Starred", "Nation"]
INSTRUCTIONS = "Give one reason in the form: of ..."


@query
def c12_row_prompt(spark, sf):
    rows = _prompt_rows(spark, sf)
    return rows.select("c_custkey", prompts.row_prompt(rows, PROMPT_COLUMNS).alias("prompt"))


@query
def c13_request_table(spark, sf):
    rows = _prompt_rows(spark, sf)
    asked = rows.select("c_custkey", prompts.row_prompt(rows, PROMPT_COLUMNS).alias("prompt"))
    # The regions serve as the example pairs.
    examples = X.table(spark, sf, "region").select(
        F.col("r_regionkey").alias("idx"), F.col("r_name").alias("input"), F.concat(F.lit("of "), F.lower("r_name")).alias("output")
    )
    built = prompts.request_table(asked, "prompt", INSTRUCTIONS, examples)
    return built.select("c_custkey", F.posexplode("messages").alias("pos", "m")).select("c_custkey", "pos", "m.role", "m.content")


@query
def c14_row_prefix(spark, sf):
    rows = _prompt_rows(spark, sf).select("c_custkey", "Name")
    return prompts.limited_result(rows, "c_custkey", 25, "result", F.concat(F.lit("Name: "), F.col("Name")))


@query
def c15_page_text(spark, sf):
    return sites.page_text(X.table(spark, sf, "pages"))


@query
def c16_site_text(spark, sf):
    return sites.site_text(X.table(spark, sf, "pages"))


# Embedding and similarity


@query
def d1_hash_embed(spark, sf):
    return round_columns(embedding.hashed_terms_long(X.companies(spark, sf), "company_id", "Description"), "v")


@query
def d1_latent_embed(spark, sf):
    docs = X.companies(spark, sf)
    vectors = latent.with_latent(docs, ["company_id"], "Description", latent.fit_latent(docs, "Description"))
    return vectors.select("company_id", F.posexplode("vec").alias("dim", "v")).select("company_id", "dim", rounded("v").alias("v"))


@query
def d2_mean_pool(spark, sf):
    tokens = X.vectors(spark, sf).withColumn("mask", (F.get("vec", F.lit(0)) > 0).cast("int"))
    pooled = embedding.mean_pool(tokens, "label", "vec", "mask")
    return pooled.select("label", F.posexplode("vec").alias("dim", "v")).select("label", "dim", rounded("v").alias("v"))


@query
def d3_l2_normalize(spark, sf):
    unit = X.vectors(spark, sf).select("vec_id", V.l2_normalize(F.transform("vec", lambda x: x * 3)).alias("vec"))
    return unit.select("vec_id", F.posexplode("vec").alias("dim", "v")).select("vec_id", "dim", rounded("v").alias("v"))


@query
def d4_hash_embed_raw(spark, sf):
    return embedding.hashed_terms_long(X.companies(spark, sf), "company_id", "Description", normalize=False)


@query
def d5_keyword_vectors(spark, sf):
    keys = X.table(spark, sf, "benchmark").select(F.col("text").alias("name"), (F.col("item_id") + 1).alias("weight"))
    vecs = embedding.phrase_vectors(keys)
    return round_columns(inlined(vecs, ["name", "weight"], F.col("terms"), ["dim", "v"]), "v")


def _pairs(spark, sf, mode) -> DataFrame:
    sims = similarity_rows(X.vectors(spark, sf), "vec_id", X.key_vectors(spark, sf), DENSE, mode)
    return round_columns(sims, "sim")


@query
def d6_cosine(spark, sf):
    return _pairs(spark, sf, "cosine")


@query
def d7_euclid(spark, sf):
    return _pairs(spark, sf, "euclid")


@query
def d8_mult(spark, sf):
    return _pairs(spark, sf, "mult")


@query
def d9_legacy_mult(spark, sf):
    return _pairs(spark, sf, "legacy_mult")


@query
def d10_add(spark, sf):
    return _pairs(spark, sf, "add")


@query
def e1_phrase_grid(spark, sf):
    keys = embedding.phrase_vectors(X.phrases(spark))
    return round_columns(similarity_rows(X.companies(spark, sf), "company_id", keys, HashedText("Description")), "sim")


@query
def e2_sector_grid(spark, sf):
    sims = similarity_rows(X.vectors(spark, sf), "vec_id", X.sector_vectors(spark, sf), DENSE, "mult")
    return round_columns(sims, "sim")


@query
def e3_contact_messages(spark, sf):
    return messages.contact_messages(X.mail_contacts(spark, sf), X.mail(spark, sf))


@query
def e5_firm_keywords(spark, sf):
    cells = phrases.tf_idf(X.companies(spark, sf), "company_id", "Description", X.phrases(spark))
    return round_columns(cells.select("company_id", "name", "weight", "tf", "idf"), "tf", "idf")


# Aggregations and scores


@query
def f1_soft_idf(spark, sf):
    return round_columns(soft_idf_table(X.vectors(spark, sf), "vec_id", X.key_vectors(spark, sf), DENSE), "idf")


@query
def f2_soft_tfidf(spark, sf):
    return round_columns(soft_scores(X.vectors(spark, sf), "vec_id", {"score": X.key_vectors(spark, sf)}, DENSE), "score")


@query
def f3_minmax(spark, sf):
    rows = X.table(spark, sf, "customer").select("c_custkey", "c_acctbal", F.lit(7.0).alias("same"))
    out = ranking.minmax(rows, {"c_acctbal": "scaled", "same": "constant"})
    return round_columns(out.select("c_custkey", "scaled", "constant"), "scaled", "constant")


def _combined(spark, sf, mode, combine) -> DataFrame:
    scored = relevance.scored_rows(
        X.vectors(spark, sf), "vec_id", X.key_vectors(spark, sf), DENSE, X.sector_vectors(spark, sf), mode, combine
    )
    return round_columns(scored, *SCORES)


@query
def f4_score_sum(spark, sf):
    return _combined(spark, sf, "mult", "sum")


@query
def f4_score_product(spark, sf):
    return _combined(spark, sf, "mult", "product")


@query
def f5_weighted_cosine(spark, sf):
    return round_columns(relevance.cosine_scores(X.vectors(spark, sf), "vec_id", X.key_vectors(spark, sf), DENSE), "score")


@query
def f6_best_sector(spark, sf):
    best = relevance.predict_sector(X.vectors(spark, sf), "vec_id", X.sector_vectors(spark, sf), DENSE, "add")
    return round_columns(best, "sim")


@query
def f7_label_stats(spark, sf):
    rows = X.labelled_companies(spark, sf).withColumn("score", T.word_count(F.col("text")) / 10)
    return round_columns(ranking.label_stats(rows, "starred", "score", "prior"), "mean_score", "sd_score", "mean_prior")


# Clusters


@query
def g1_kmeans(spark, sf):
    _, placed = clusters.kmeans(X.vectors(spark, sf), "vec_id", "vec", 10)
    return placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query
def g1_lloyd_steps(spark, sf):
    moved = clusters.lloyd_steps(X.vectors(spark, sf), "vec", X.first_centroids(spark, sf), 2)
    return moved.select("cluster", "n", F.posexplode("vec").alias("dim", "v")).select("cluster", "n", "dim", rounded("v").alias("v"))


@query
def g2_assign(spark, sf):
    return clusters.assign(X.vectors(spark, sf), "vec_id", "vec", X.first_centroids(spark, sf))


@query
def g3_silhouette_exact(spark, sf):
    return round_columns(clusters.silhouette_exact(X.vectors(spark, sf), "vec_id", "vec", "label"), "s")


@query
def g3_silhouette_squared(spark, sf):
    return round_columns(clusters.silhouette_squared(X.vectors(spark, sf), "vec_id", "vec", "label"), "s")


@query
def g4_k_sweep(spark, sf):
    return round_columns(clusters.k_sweep(X.vectors(spark, sf), "vec_id", "vec", exact=True), "silhouette", "error")


# Order, cuts, mail tables


@query
def h1_rank(spark, sf):
    rows = X.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return ranking.ranked(rows, ranking.best_first("c_acctbal", "c_custkey"))


@query
def h2_top_n(spark, sf):
    rows = X.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return ranking.top_n(rows, ranking.best_first("c_acctbal", "c_custkey"), 500)


def _chosen(spark, sf, n) -> DataFrame:
    docs = X.companies(spark, sf).select(
        "company_id", F.length("Description").alias("score"), T.word_count(F.col("Description")).alias("words")
    )
    return ranking.choose_top(docs, ranking.best_first("score", "company_id"), F.col("words"), 20, n)


@query
def h3_choose_top_n(spark, sf):
    return _chosen(spark, sf, 150)


@query
def h3_choose_top_auto(spark, sf):
    return _chosen(spark, sf, -1)


@query
def h4_index(spark, sf):
    found = messages.contact_messages(X.mail_contacts(spark, sf), X.mail(spark, sf))
    return messages.message_index(found).select("email", "direction", "message_id", "message_index")


def _long(spark, sf) -> DataFrame:
    return messages.long_table(X.mail_contacts(spark, sf), X.mail(spark, sf))


@query
def h5_long(spark, sf):
    return _long(spark, sf)


@query
def h6_wide(spark, sf):
    return messages.wide_mail(X.mail_contacts(spark, sf), X.mail(spark, sf))


@query
def h7_message_text(spark, sf):
    return X.payloads(spark, sf).select("message_id", messages.message_text(F.col("payload")).alias("content"))


# Requests


@query
def s1_requests(spark, sf):
    inbox, out, state = (scratch_path(spark, n) for n in ("form-inbox", "form-parsed", "form-state"))
    X.form_rows(spark, sf).write.json(inbox)
    requests.store_parsed(requests.read_requests(spark, inbox), out, state).awaitTermination()
    return spark.read.parquet(out).select("request_id", "email", "file_id", "error")


@query
def s1_form_sheet(spark, sf):
    sheet, out, state = (scratch_path(spark, n) for n in ("form-sheet", "form-parsed", "form-state"))
    X.form_rows(spark, sf).write.json(sheet)
    requests.store_parsed(form_sheet.read_sheet(spark, sheet), out, state).awaitTermination()
    rows = spark.read.parquet(out)
    # Rows are numbered without a gap.
    last = rows.agg(F.max("row").alias("m")).scalar()
    return rows.select("email", "file_id", "error", last.alias("last_row"))


@query
def a5_cached_clusters(spark, sf):
    docs, cache = X.companies(spark, sf), scratch_path(spark, "vector-cache")
    first = X.labelled_companies(spark, sf)
    clustering.company_clusters(first, "company_id", "text", cache, 5)
    placed = clustering.company_clusters(docs, "company_id", "Description", cache, 5)
    return placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query
def s2_request_parse(spark, sf):
    parsed = requests.parse_requests(X.form_rows(spark, sf))
    return inlined(parsed, ["request_id", "sector", "file_id"], F.col("phrases"), ["name", "weight"])


@query
def s3_request_gate(spark, sf):
    gated = requests.gate_requests(requests.parse_requests(X.form_rows(spark, sf)), X.form_files(spark, sf))
    return gated.select("file_id", "file_name", "error")


@query
def s4_scored_requests(spark, sf):
    # One form row per market segment, each scored over all documents.
    rows = (
        X.table(spark, sf, "customer")
        .groupBy("c_mktsegment")
        .agg(F.min("c_custkey").alias("k"), F.count(F.lit(1)).alias("n"))
        .select(
            F.lit("2024-01-01 00:00:00").alias("submitted"),
            F.lower("c_mktsegment").alias("email"),
            F.lit("").alias("sector"),
            F.concat(F.lit("and the="), F.col("n").cast("string"), F.lit("\nworthless")).alias("phrases"),
            F.concat(F.lit("open?id=f"), F.col("k").cast("string")).alias("link"),
        )
    )
    inbox, out, state = (scratch_path(spark, n) for n in ("ask-inbox", "ask-out", "ask-state"))
    rows.write.json(inbox)
    docs = X.companies(spark, sf)

    def score(request: dict, reuse) -> DataFrame:
        keys = keywords.keyword_table(spark, request["phrases"])
        best = leads.lead_ranking(docs, "company_id", keys, verify_email=False, rename=False, n=20, reuse=reuse)
        return best.select(F.lit(request["email"]).alias("email"), "company_id", "score", "rank")

    files = X.form_files(spark, sf)
    requests.answer_requests(requests.read_requests(spark, inbox), files, score, out, state).awaitTermination()
    return round_columns(spark.read.parquet(f"{out}/results").drop("request_id"), "score")


# Jobs


def _leads(spark, sf) -> DataFrame:
    rows = X.companies(spark, sf).join(X.contacts(spark, sf), "company_id")
    rows = rows.withColumnRenamed("lang", "lang_x").withColumn("lang_y", F.lit("?"))
    return leads.lead_ranking(rows, "company_id", X.phrases(spark), relevance.sector_phrases(X.sector_text(spark), "sector"))


@query
def l1_lead_ranking(spark, sf):
    best = _leads(spark, sf)
    return round_columns(
        best.select("company_id", "lang", F.col(f"`{slot_column('email', 1)}`").alias("email_1"), *SCORES, "rank"), *SCORES
    )


@query
def l1_lead_requests(spark, sf):
    examples = X.table(spark, sf, "region").select(
        F.col("r_regionkey").alias("idx"), F.col("r_name").alias("input"), F.concat(F.lit("of "), F.lower("r_name")).alias("output")
    )
    built = leads.lead_requests(_leads(spark, sf), "company_id", INSTRUCTIONS, examples, ["lang", "source", "rank"])
    return built.select("company_id", F.posexplode("messages").alias("pos", "m")).select("company_id", "pos", "m.role", "m.content")


@query
def l1_lead_replies(spark, sf):
    return leads.with_replies(_leads(spark, sf), "company_id", X.lead_replies(spark, sf)).select("company_id", "rank", "WLYB")


def flagship(spark, sf) -> DataFrame:
    rank = relevance.relevance_rank(X.vectors(spark, sf), "vec_id", X.key_vectors(spark, sf), DENSE, X.sector_vectors(spark, sf))
    return round_columns(rank, *SCORES)


@query
def l2_relevance_rank(spark, sf):
    return flagship(spark, sf)


@query
def l2_text_rank(spark, sf):
    sectors = relevance.sector_phrases(X.sector_text(spark), "sector")
    rank = relevance.text_rank(X.companies(spark, sf), "company_id", "Description", X.phrases(spark), sectors, dims=2**18)
    return round_columns(rank, *SCORES)


@query
def l2_latent_rank(spark, sf):
    sectors = relevance.sector_phrases(X.sector_text(spark), "sector")
    rank = relevance.latent_rank(X.companies(spark, sf), "company_id", "Description", X.phrases(spark), sectors)
    return round_columns(rank, *SCORES)


@query
def l4_latent_sector(spark, sf):
    sectors = X.table(spark, sf, "benchmark").select(F.col("text").alias("name"), F.lit(1.0).alias("weight"))
    return round_columns(relevance.latent_sector(X.companies(spark, sf), "company_id", "Description", sectors, mode="add"), "sim")


@query
def l3_legacy_rank(spark, sf):
    rank = relevance.legacy_rank(X.vectors(spark, sf), "vec_id", X.key_vectors(spark, sf), DENSE, X.sector_vectors(spark, sf))
    return round_columns(rank, *SCORES)


@query
def l4_sector_prediction(spark, sf):
    return round_columns(relevance.predict_sector(X.vectors(spark, sf), "vec_id", X.sector_vectors(spark, sf), DENSE), "sim")


@query
def l5_site_rank(spark, sf):
    return round_columns(relevance.site_rank(X.table(spark, sf, "pages"), X.phrases(spark)), "density")


@query
def l6_cosine_top500(spark, sf):
    return round_columns(relevance.cosine_top(X.vectors(spark, sf), "vec_id", X.key_vectors(spark, sf), DENSE, 500), "score")
