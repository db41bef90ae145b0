"""Channel, post, relation and message tables derived from the supplied test data.

The definitions are those of FIXTURES.md, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators.joins import lookup_join
from driftline.session import pieces


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    blank_title = F.when(key % 11 == 5, F.lit("  "))
    title = F.coalesce(blank_title, F.concat("p_name", F.lit(" "), F.lower("p_type")))
    return table(spark, sf_dir, "part").select(
        key.alias("channel_id"),
        F.when(key % 7 == 3, "").otherwise(F.concat(F.lit("ch_"), key.cast("string"))).alias("username"),
        F.when(key % 11 != 4, title).alias("title"),
        (key % 1000).alias("participants_count"),
        (key % 2).cast("int").alias("broadcast"),
        (key % 3 == 0).cast("int").alias("megagroup"),
        (key % 5 == 0).cast("int").alias("verified"),
        (key % 13 == 0).cast("int").alias("scam"),
        (key % 17 == 0).cast("int").alias("fake"),
    )


def _message_id():
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("message_id")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message feed of the traversal."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("channel_id"),
        _message_id(),
        F.col("l_shipdate").cast("timestamp").alias("date"),
        (F.col("l_returnflag") == "R").alias("is_forwarded"),
        F.col("l_suppkey").alias("from_id"),
        F.lit(None).cast("string").alias("from_name"),
    )


def _relation_ids(lineitem: DataFrame) -> DataFrame:
    unknown = (F.col("l_orderkey") + F.col("l_linenumber")) % 10 == 0
    fallback = F.when(unknown & (F.col("l_linenumber") % 2 == 0), F.concat(F.lit("Anon "), "l_returnflag"))
    return lineitem.select(
        F.col("l_partkey").alias("channel_to_id"),
        F.when(~unknown, F.col("l_suppkey")).alias("channel_from_id"),
        F.coalesce(fallback, F.lit("")).alias("from_name_fallback"),
        _message_id().alias("target_message_id"),
        F.col("l_shipdate").cast("timestamp").alias("target_message_date_utc"),
        F.lit(0).alias("sampling_depth"),
    )


def _with_names(rows: DataFrame, names: DataFrame, parts: int | None = None) -> DataFrame:
    for side in ("to", "from"):
        lookup = names.select(
            F.col("channel_id").alias(f"channel_{side}_id"),
            F.col("username").alias(f"channel_{side}_username"),
            F.col("title").alias(f"channel_{side}_title"),
        )
        rows = lookup_join(rows, lookup, f"channel_{side}_id", parts=parts)
    return rows


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per forward, names of both channels looked up."""
    return _with_names(_relation_ids(table(spark, sf_dir, "lineitem")), channels(spark, sf_dir))


def relation_pieces(spark: SparkSession, sf_dir: str) -> int:
    """Number of tasks for the forwards, which the file footers count."""
    return pieces(spark, table(spark, sf_dir, "lineitem").count())


def relation_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations counted by ids before any name is looked up, number of forwards in ``copies``.

    The lookups then touch one row per pair of channels, not one per forward. The
    pairs are dealt out again, so that a task names a bounded number of them; as
    each is there once, none is frequent.
    """
    parts = relation_pieces(spark, sf_dir)
    ids = _relation_ids(table(spark, sf_dir, "lineitem"))
    keys = ["channel_to_id", "channel_from_id", "from_name_fallback"]
    counted = ids.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).repartition(parts)
    return _with_names(counted, channels(spark, sf_dir), parts)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    origin = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + key * 420)
    linked = F.when(key % 6 == 1, F.concat("text", F.lit(" https://t.me/x"), key.cast("string"))).otherwise(F.col("text"))
    forwarded = key % 4 == 0
    return table(spark, sf_dir, "documents").select(
        key.alias("message_id"),
        F.col("source").alias("channel_username"),
        F.when(key % 5 != 3, origin).alias("date"),
        F.when(key % 50 == 7, None).when(key % 50 == 9, "   ").otherwise(linked).alias("text"),
        ((key * 37) % 1000).alias("views"),
        ((key * 13) % 50).alias("forwards"),
        forwarded.alias("is_forwarded"),
        F.when(forwarded, F.concat(F.lit("channel_id:"), (key % 9).cast("string"))).alias("forward_from_chat"),
    )


def raw_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel references as users type them, seven kinds."""
    key = F.col("p_partkey")
    name = F.concat(F.lit("ch_"), key.cast("string"))
    raw = (
        F.when(key % 12 == 6, F.concat(F.lit("https://t.me/@"), name))
        .when(key % 6 == 0, F.concat(F.lit("@"), name))
        .when(key % 6 == 1, F.concat(F.lit("@@"), name, F.lit(" ")))
        .when(key % 6 == 2, F.concat(F.lit(" https://t.me/"), name, F.lit(" ")))
        .when(key % 6 == 3, F.concat(F.lit(" @"), name))
        .when(key % 6 == 4, "@")
        .otherwise("  ")
    )
    return table(spark, sf_dir, "part").select(key.alias("channel_id"), raw.alias("raw"))


def raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as ISO text: bare, with a time, with an offset, with a space."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    hour = F.lpad((key % 24).cast("string"), 2, "0")
    raw = (
        F.when(key % 4 == 0, day)
        .when(key % 4 == 1, F.concat(day, F.lit("T"), hour, F.lit(":15:00")))
        .when(key % 4 == 2, F.concat(day, F.lit("T"), hour, F.lit(":15:00+02:00")))
        .otherwise(F.concat(day, F.lit(" "), hour, F.lit(":15:00")))
    )
    return table(spark, sf_dir, "orders").select(key.alias("order_id"), raw.alias("raw"))


def raw_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text: plain, padded, missing, fractional, negative."""
    key = F.col("event_id")
    user = F.col("user_id").cast("string")
    raw = (
        F.when(key % 5 == 0, user)
        .when(key % 5 == 1, F.concat(F.lit("  "), user, F.lit(" ")))
        .when(key % 5 == 2, "n/a")
        .when(key % 5 == 3, F.concat(user, F.lit(".5")))
        .otherwise(F.concat(F.lit("-"), user))
    )
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))


def earlier_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel rows of two earlier runs, which found some channels at different depths."""
    found = channels(spark, sf_dir).select("channel_id", "username")
    key = F.col("channel_id")
    first = found.filter(key % 3 != 0).withColumn("discovered_depth", (key % 4).cast("int"))
    second = found.filter(key % 2 == 0).withColumn("discovered_depth", (key % 5).cast("int"))
    return first.unionByName(second)


def chat_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forwards from chats to message channels: few targets, so a wide matrix makes sense."""
    blank = F.lit("")
    return messages(spark, sf_dir).filter("is_forwarded").select(
        F.lit(None).cast("long").alias("channel_to_id"),
        F.col("channel_username").alias("channel_to_username"),
        blank.alias("channel_to_title"),
        (F.col("message_id") % 9).alias("channel_from_id"),
        blank.alias("channel_from_username"),
        blank.alias("channel_from_title"),
        blank.alias("from_name_fallback"),
        F.col("message_id").alias("target_message_id"),
    )


def header_posts(events: DataFrame) -> DataFrame:
    """Posts with a forward header, one of eight kinds, from event rows."""
    key = F.col("event_id")
    kind = key % 8

    def peer(kinds: dict):
        fields = [
            F.when(kind == kinds[name], key).alias(name) if name in kinds else F.lit(None).cast("long").alias(name)
            for name in ("channel_id", "chat_id", "user_id")
        ]
        return F.when(kind.isin(list(kinds.values())), F.struct(*fields))

    header = F.struct(
        F.when(kind == 1, F.concat(F.lit("Name "), F.col("user_id").cast("string"))).alias("from_name"),
        peer({"channel_id": 2, "chat_id": 3, "user_id": 4}).alias("from_id"),
        peer({"channel_id": 5}).alias("saved_from_peer"),
        F.when(kind == 6, key).alias("saved_from_msg_id"),
    )
    return events.select(
        key.alias("message_id"),
        F.col("user_id").cast("string").alias("channel_username"),
        F.col("ts").cast("timestamp").alias("date"),
        F.when(kind != 2, F.col("props")).alias("text"),
        F.when(kind != 3, key % 100).alias("views"),
        F.when(kind != 5, key % 10).alias("forwards"),
        F.when(kind != 0, header).alias("fwd_from"),
    )


def term_bucket(term, size):
    """Vector number of a term: eight hex digits of its digest modulo the number of vectors."""
    return F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % size


def doc_vectors(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """Vector of each document: embedding number message_id modulo their count."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("doc_vector"))
    size = vectors.agg(F.count(F.lit(1))).scalar()
    return docs.select("doc_id", (F.col("message_id") % size).alias("vec_id")).join(vectors, "vec_id").drop("vec_id")


def term_vectors(spark: SparkSession, sf_dir: str, terms: DataFrame) -> DataFrame:
    """Vector of each term, picked by the digest of the term."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("term_vector"))
    size = vectors.agg(F.count(F.lit(1))).scalar()
    return terms.select("term", term_bucket(F.col("term"), size).alias("vec_id")).join(vectors, "vec_id").drop("vec_id")
