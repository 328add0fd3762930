"""Document frequencies kept up to date by hours instead of recounted.

``path`` holds two tables, both with a folder per hour:

    versions   article_id, terms: what an hour published, dealt to buckets of ids
    counts     keyword, df, n: what the hour changed; a null keyword counts articles

An hour adds its articles and withdraws the version each of them had before. The
counts are a function of the stored versions alone, so an hour may be repeated
after a lost run, replaced, or come late: the hours after it that republished
its articles are then counted again. Sums over all hours equal a full count of
each article's newest version.

The words of a version are written once and never shuffled, but for articles that
appear twice in an hour: which versions an hour withdraws is found from their ids
and places, and told to the tasks that read them by one bit per stored version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoflow.operators import keywords
from recoflow.operators.ranks import range_rank
from recoflow.session import materialize
from recoflow.sources import tables

VERSIONS = "article_id long, terms array<struct<term: string, tf: long>>, hour string, bucket int"
COUNTS = "keyword string, df long, n long"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All hours of a table; a folder without files is an empty table."""
    return spark.read.schema(schema).parquet(path) if tables.exists(spark, path) else spark.createDataFrame([], schema)


def _write(df: DataFrame, path: str, by: list[str] = []) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)


def _changes(versions: DataFrame, hour: str, touched: list[int]) -> DataFrame:
    """(keyword, df, n) that ``hour`` adds, less what its articles had before."""
    place = ["hour", "bucket", "_file", "_word"]
    rows = versions.where(F.col("bucket").isin(touched) & (F.col("hour") <= hour)).select(
        *versions.columns, F.col("_metadata.file_name").alias("_file"),
        F.shiftright("_metadata.row_index", 6).alias("_word"),
        F.col("_metadata.row_index").bitwiseAND(F.lit(63)).cast("int").alias("_bit"))
    # The newest version before this hour of each of its articles, by ids and places alone.
    is_now = F.col("hour") == hour
    newest = rows.groupBy("article_id").agg(
        F.max(is_now).alias("now"), F.max(F.when(~is_now, F.struct(*place, "_bit"))).alias("last"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))
    gone = (newest.where("now AND last IS NOT NULL").select("last.*")
            .groupBy(*place).agg(F.bit_or(one).alias("_gone")))
    signed = rows.join(F.broadcast(gone), place, "left").withColumn(
        "sign", F.when(is_now, F.lit(1)).when(F.col("_gone").bitwiseAND(one) != 0, F.lit(-1)))
    signed = signed.where(F.col("sign").isNotNull())
    entry = F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("tf"))
    terms = signed.select("sign", F.explode(F.concat(F.array(entry), F.coalesce("terms", F.array()))).alias("t"))
    return terms.groupBy(F.col("t.term").alias("keyword")).agg(
        F.sum("sign").cast("long").alias("df"), F.sum(F.col("sign") * F.col("t.tf")).cast("long").alias("n")
    ).where((F.col("df") != 0) | (F.col("n") != 0))


def _versions(tokens: DataFrame) -> DataFrame:
    """(article_id, terms): one version per article; only articles that appear twice are moved."""
    size = F.size("terms")
    best = Window.partitionBy("article_id").orderBy(size.desc(), F.col("terms").desc())
    tokens = tokens.where(F.col("article_id").isNotNull()).withColumn("article_id", F.col("article_id").cast("long"))
    counted = lambda t: keywords.term_counts(t).select("article_id", "terms")
    twice = materialize(tokens.groupBy("article_id").count().where(F.col("count") > 1).select("article_id"), "twice")
    if twice.isEmpty():
        return counted(tokens)
    again = counted(tokens.join(twice, "article_id", "left_semi"))
    again = again.withColumn("_n", F.row_number().over(best)).where(F.col("_n") == 1).drop("_n")
    return counted(tokens.join(twice, "article_id", "left_anti")).unionByName(again)


def add_hour(tokens: DataFrame, path: str, hour: str, buckets: int = 256) -> list[str]:
    """Publish (article_id, channel_id, words) as the articles of ``hour`` (a sortable text);
    the hours that were counted.

    Of an article that appears twice in an hour, the version with the most terms
    counts, ties by the terms. Rows without article id are left out. An article
    without words has a version too: it withdraws the one before. Read are the
    buckets that the hour's ids, old and new, fall into.
    """
    spark = tokens.sparkSession
    root = path.rstrip("/")
    # Written beside the table, whose name it takes when the old ids are known.
    staged, target = f"{root}/staged/hour={hour}", f"{root}/versions/hour={hour}"
    _write(tables.with_bucket(_versions(tokens), ["article_id"], buckets), staged, ["bucket"])
    new = _read(spark, staged, "article_id long, terms array<struct<term: string, tf: long>>, bucket int")
    versions = _read(spark, f"{root}/versions", VERSIONS)
    ids = new.select("article_id", "bucket").unionByName(
        versions.where(F.col("hour") == hour).select("article_id", "bucket"))
    ids = materialize(ids.distinct(), "ids")
    touched = [r[0] for r in ids.select("bucket").distinct().collect()]      # at most one number per bucket
    later = versions.where(F.col("bucket").isin(touched) & (F.col("hour") > hour)).join(
        ids, ["article_id", "bucket"], "left_semi").select("hour").distinct()
    hours = [hour, *sorted(r[0] for r in later.collect())]                   # at most one text per hour
    tables.move(spark, staged, target)
    versions = _read(spark, f"{root}/versions", VERSIONS)
    for h in hours:
        # A later hour changed in the touched buckets only; the others are read as well, to count it whole.
        among = touched if h == hour else list(range(buckets))
        _write(_changes(versions, h, among), f"{root}/counts/hour={h}")
    return hours


def frequencies(spark: SparkSession, path: str) -> DataFrame:
    """(keyword, df, n) over the newest version of each article; the null keyword counts articles."""
    return _read(spark, f"{path.rstrip('/')}/counts", COUNTS).groupBy("keyword").agg(
        F.sum("df").alias("df"), F.sum("n").alias("n")).where(F.col("df") > 0)


def idf_table(spark: SparkSession, path: str) -> DataFrame:
    """(keyword, idf, index) as ``keywords.idf_table`` of the newest versions, from counts alone."""
    known = materialize(frequencies(spark, path), "frequencies")
    documents = known.where(F.col("keyword").isNull()).agg(F.coalesce(F.sum("df"), F.lit(0))).scalar()
    idf = known.where(F.col("keyword").isNotNull()).select(
        "keyword", "n", F.log((documents + 1.0) / (F.col("df") + 1.0)).alias("idf"))
    return range_rank(idf, [F.desc("n"), F.col("keyword")], "index").select("keyword", "idf", "index")
