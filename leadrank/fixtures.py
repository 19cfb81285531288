"""The test tables in the shapes the operators work on.

Every fixture covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadrank.functions.contacts import FIELDS, SLOTS, slot_column
from leadrank.operators.embedding import mean_pool
from leadrank.sources.keywords import keyword_table

# Phrases that occur in the English documents, with weights.
PHRASES = {"and the": 10, "of the": 5, "thatin": 5, "ononst": 7, "worthless": 20}
SECTOR_TEXT = "Thatin of the. Worthless ononst? and the tion."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def phrases(spark: SparkSession) -> DataFrame:
    return keyword_table(spark, PHRASES)


def sector_text(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(SECTOR_TEXT,)], "sector string")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, vec)``"""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("vec")
    )


def key_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First vector of each label, as weighted keys."""
    firsts = vectors(spark, sf_dir).groupBy("label").agg(F.min_by("vec", "vec_id").alias("vec"))
    return firsts.select(
        F.concat(F.lit("key "), "label").alias("name"), (F.lit(1.0) + F.col("label") % 5).alias("weight"), "vec"
    )


def sector_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vector of each label, as sectors."""
    means = mean_pool(vectors(spark, sf_dir).withColumn("one", F.lit(1)), "label", "vec", "one")
    return means.select(F.concat(F.lit("sector "), "label").alias("name"), F.lit(1.0).alias("weight"), "vec")


def first_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First vector of each label, as starting centroids."""
    return vectors(spark, sf_dir).groupBy(F.col("label").alias("cluster")).agg(F.min_by("vec", "vec_id").alias("vec"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(company_id, Description, lang, source)``"""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("company_id"), F.col("text").alias("Description"), "lang", "source"
    )


def labelled_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies with a ``starred`` flag and a prior score."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("company_id"), (F.col("quality") == 1).alias("starred")
    )
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("company_id"), "text", F.col("n_chars").cast("double").alias("prior")
    )
    return docs.join(labels, "company_id")


TITLES = ("Owner", "CEO ", "Co-Founder", "President", "VP Sales", "Chief Executive Officer", "Executive Assistant", "Engineer")
FIRST_NAMES = ("Ana", "Bo", "Carla", "", " Dee")
LAST_NAMES = ("Kim", "Lopez", "Moss", "Ng")
EMAILS = ("ana@mail.com", "bk@mail.com", "info@mail.com", "c.lopez@mail", "", "Moss.D@mail.org ", "a@b@mail.com")


def contact_rule(field: str, slot: int) -> tuple[int, tuple[str, ...]]:
    """Step and values of a made-up contact field.

    The value is number ``(c_custkey + step) % (len(values) + 1)``; there is one
    residue more than values, and that one stays null.
    """
    return {
        "title": (slot * slot, TITLES),
        "first_name": (slot, FIRST_NAMES),
        "last_name": (slot * 2, LAST_NAMES),
        "email": (slot * 3, EMAILS),
    }[field]


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``company_id`` and three contact slots for every customer."""

    def value(field: str, slot: int):
        step, values = contact_rule(field, slot)
        at = (F.col("c_custkey") + step) % (len(values) + 1)
        return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int")).alias(slot_column(field, slot))

    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("company_id"), *[value(f, s) for s in SLOTS for f in FIELDS]
    )


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as messages between ``c<id>@mail.example.com`` and us."""
    turns = table(spark, sf_dir, "conversations")
    them = F.concat(F.lit("C"), F.col("conv_id").cast("string"), F.lit("@mail.example.com"))
    us = F.lit("me@mail.example.com")
    # Instructions count as mail of ours.
    outgoing = F.coalesce(F.col("role").isin("assistant", "system"), F.lit(False))
    return turns.select(
        F.format_string("%d-%d", "conv_id", "turn").alias("message_id"),
        F.col("turn").alias("sent"),
        F.when(outgoing, us).otherwise(them).alias("from_addr"),
        F.array(F.when(outgoing, them).otherwise(us)).alias("to_addrs"),
        F.concat(F.lit("Subject: Conversation "), F.col("conv_id").cast("string"), F.lit("\n\n"), "text").alias(
            "content"
        ),
        "conv_id",
        "turn",
        "text",
    )


def mail_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One address per customer and per conversation; many have no mail."""
    ids = (
        table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"))
        .union(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")))
    )
    return ids.distinct().select(
        F.concat(F.lit("c"), F.col("id").cast("string"), F.lit("@mail.example.com")).alias("email")
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as nested MIME: plain part first, or up to ten multipart levels down."""
    from leadrank.operators.messages import payload_of

    # Spark breaks long base64 into lines; bodies have none.
    data = F.translate(F.base64(F.encode("text", "utf-8")), "+/\r\n", "-_")
    leaf = F.concat(F.lit('{"mimeType":"text/plain","body":{"data":"'), data, F.lit('"}}'))
    html = F.concat(F.lit('{"mimeType":"text/html","body":{"data":"'), data, F.lit('"}}'))

    def wrapped(inner: Column, _: Column) -> Column:
        return F.concat(F.lit('{"mimeType":"multipart/mixed","body":{},"parts":['), html, F.lit(","), inner, F.lit("]}"))

    levels = F.when(F.col("from_addr") == "me@mail.example.com", F.lit(0)).otherwise(1 + (F.col("conv_id") + F.col("turn")) % 10)
    nested = F.aggregate(F.slice(F.sequence(F.lit(0), F.lit(10)), 1, levels.cast("int")), leaf, wrapped)
    headers = F.concat(
        F.lit('[{"name":"To","value":"'), F.element_at("to_addrs", 1),
        F.lit('"},{"name":"Subject","value":"Conversation '), F.col("conv_id").cast("string"), F.lit('"}]'),
    )
    payload = F.concat(F.lit('{"headers":'), headers, F.lit(',"parts":['), nested, F.lit(","), leaf, F.lit("]}"))
    return mail(spark, sf_dir).select("message_id", payload_of(payload).alias("payload"))


def form_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A form request per customer."""
    return table(spark, sf_dir, "customer").select(
        F.lit("2024-01-01 00:00:00").alias("submitted"),
        F.concat(F.lower("c_name"), F.lit("@mail.example.com")).alias("email"),
        F.concat("c_mktsegment", F.lit(" goods. Nation "), F.col("c_nationkey").cast("string")).alias("sector"),
        F.concat(
            F.lit('"'), F.lower("c_mktsegment"), F.lit('"='), F.col("c_nationkey").cast("string"), F.lit(",\n"),
            F.lit("and the\n\na=b=c\nof the=2\nof the=3.5"),
            F.when(F.col("c_acctbal") < 0, F.lit("\nbroken=many")).otherwise(F.lit("")),
        ).alias("phrases"),
        F.concat(F.lit("https://files.example.com/open?id= f"), F.col("c_custkey").cast("string")).alias("link"),
    )


def form_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(file_id, file_name)`` of the uploaded files; some are no CSV."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("f"), F.col("c_custkey").cast("string")).alias("file_id"),
        F.concat(
            F.lit("list "), F.col("c_custkey").cast("string"),
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit(".xlsx")).otherwise(F.lit(".csv")),
        ).alias("file_name"),
    )


def founder_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model reply per customer: founders, chatter and unusable lines."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("reply_id"),
        F.concat(
            F.lit("Here they are:\n Founder 1: "), F.col("c_name"), F.lit(", "), F.initcap("c_mktsegment"),
            F.lit(" Head, Chair \nFounder 2: Ann Lee\n"),
            F.when(F.col("c_acctbal") > 5000, F.lit("Founder 3: Bo Ng, CTO: Lab, Member\n")).otherwise(F.lit("Founder 3 unknown\n")),
            F.lit("\nFounders are listed above."),
        ).alias("reply"),
    )


def lead_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's reply for customers with an account; some give no reason."""
    reason = F.concat(F.lit("A good match because of "), F.lower("c_mktsegment"), F.lit(" goods.\nMore of the same."))
    return table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("company_id"), F.when(F.col("c_nationkey") % 5 != 0, reason).otherwise("No reason.").alias("reply")
    )


def keyword_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small keyword object per part, with keys that differ only in case."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("set_id"),
        F.format_string(
            '{"%s": %d, "%s": %d, "%s": 5}', F.initcap("p_name"), F.col("p_size"), F.col("p_name"), F.col("p_size") + 1, F.col("p_brand")
        ).alias("json"),
    )
