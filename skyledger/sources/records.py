"""Landed portal pages, JSON documents and history CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.once import bound, spread
from skyledger.session import literal_table
from skyledger.spec import SPECS

# Wrapper fields searched for the record list, in order.
WRAPPERS = ["results", "records", "data", "features", "items"]

#: Files up to this size are tried as one JSON document; a text value of Spark can't hold much more.
DOCUMENT_BYTES = 512 << 20

PAGE_NUMBER = r"(\d+)\.[A-Za-z]+$"
DATASET_FILE = r"(?i)^(.*?)(?:_(?:full|metadata).*)?\.[^.]+$"


def read_record_pages(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Records of landed page files, and the files without a record list; one file is one small page."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return parse_record_pages(pages, schema)


def parse_record_pages(pages: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Records of ``(file, value)`` page texts, and the pages that hold no record list.

    A page is a bare list or an object with a list under one of the wrapper fields or ``result.records``.
    Records carry ``_page`` (the number at the end of the file name) and ``_seq`` (page, file, then position), which no
    two records share.
    """
    rows = T.ArrayType(schema)
    wrapper = T.StructType(
        [T.StructField(w, rows) for w in WRAPPERS]
        + [T.StructField("result", T.StructType([T.StructField("records", rows)]))]
    )
    text = F.ltrim("value")
    is_list = text.startswith("[")
    listed = pages.select(
        "file",
        "value",
        F.coalesce(F.regexp_extract("file", PAGE_NUMBER, 1).try_cast("long"), F.lit(0).cast("long")).alias("_page"),
        F.when(is_list, F.from_json(text, rows))
        .otherwise(
            bound(
                F.from_json(text, wrapper),
                lambda w: F.coalesce(*[w[name] for name in WRAPPERS], w["result"]["records"]),
            )
        )
        .alias("_records"),
    )
    records = (
        listed.filter(F.col("_records").isNotNull())
        .select("_page", "file", F.posexplode("_records").alias("_pos", "_record"))
        .select("_record.*", "_page", F.struct(F.col("_page").alias("page"), "file", F.col("_pos").alias("pos")).alias("_seq"))
    )
    rejects = listed.filter(F.col("_records").isNull()).select("_page", F.col("file").alias("key"), "value")
    return records, rejects


def before_first_failure(records: DataFrame, rejects: DataFrame) -> DataFrame:
    """Records of the pages before the first failed one; pages are in time order, so the rest comes next poll."""
    first_bad = rejects.agg(F.min("_page").alias("_page")).scalar()
    return records.filter(first_bad.isNull() | (F.col("_page") < first_bad))


def dataset_of_file(name="_metadata.file_name"):
    """Dataset id from a landed file name: the stem without its ``_full…`` or ``_metadata…`` tail."""
    return F.regexp_extract(F.col(name) if isinstance(name, str) else name, DATASET_FILE, 1)


def read_json_or_ndjson(
    spark: SparkSession, path: str, schema: T.StructType, layout: str = "auto", strict: bool = True
) -> DataFrame:
    """Objects from JSON lines, a JSON array or a single JSON object; blank lines are skipped.

    ``lines`` is splittable and the choice for bulk data; ``document`` parses each file whole. ``auto`` decides for
    every file by itself: a file that parses as a whole is a document, any other one holds lines, so a line that is cut
    costs that line only. Whether it parses is tried only where the first non-blank line is not a complete object and the
    ends of the lines don't rule a document out already, and on files of up to ``DOCUMENT_BYTES``; larger ones hold lines.
    Strict reading fails on anything that is not an object; otherwise such entries are dropped.
    """
    if layout == "auto":
        whole = _document_files(spark, path)
        lines = _objects(spark.read.text(path).select("*", F.col("_metadata.file_path").alias("_file")), False, strict, schema, whole)
        if not whole:
            return lines
        return lines.unionByName(_objects(spark.read.text(whole, wholetext=True), True, strict, schema))
    return _objects(spark.read.text(path, wholetext=layout == "document"), layout == "document", strict, schema)


def _whole_json(text: str) -> Column:
    """The JSON value that a text is, or NULL where there is none or anything follows it; the parser itself stops at its end."""

    def only(pair: Column) -> Column:
        alone = (F.try_variant_get(pair, "$[1]", "int") == 0) & F.try_variant_get(pair, "$[2]", "variant").isNull()
        return F.when(alone, F.try_variant_get(pair, "$[0]", "variant"))

    return bound(F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(",0]"))), only)


def _maybe_document(lines: DataFrame) -> DataFrame:
    """Files of ``(file, bytes, at, value)`` lines that may be one JSON value; all others are known to hold lines.

    No token of JSON spans lines. So a line of a document that ends with a value or a closing bracket is the last one, or the
    next one goes on with a comma, a colon or a closing bracket: a file with too few such lines is none, and nothing needs to
    read it whole.
    """
    text = F.btrim("value", F.lit(" \t\r"))
    ended = F.count_if((text != "") & ~F.right(text, F.lit(1)).isin(*"[{,:")).alias("ended")
    going_on = F.count_if(F.left(text, F.lit(1)).isin(*"]},:")).alias("going_on")
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("value"), F.max("bytes").alias("bytes"), ended, going_on)
    kind = F.coalesce(F.schema_of_variant(_whole_json("value")), F.lit(""))
    return first.filter((F.col("ended") <= F.col("going_on") + 1) & ~kind.startswith("OBJECT") & (F.col("bytes") <= DOCUMENT_BYTES))


def _document_files(spark: SparkSession, path: str) -> list[str]:
    """Files that are one JSON value rather than lines of objects; only their names reach the driver."""
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), at.alias("at")
    )
    maybe = _maybe_document(lines.filter(F.trim("value") != "")).select("file").collect()
    if not maybe:
        return []
    whole = spark.read.text(sorted(r.file for r in maybe), wholetext=True)
    parsed = whole.filter(_whole_json("value").isNotNull()).select(F.col("_metadata.file_path").alias("file"))
    return sorted(r.file for r in parsed.collect())


def _objects(texts: DataFrame, whole: bool, strict: bool, schema: T.StructType, skip: list[str] | None = None) -> DataFrame:
    texts = texts.filter(F.trim("value") != "")
    if skip:
        names = literal_table(texts.sparkSession, [(f, True) for f in skip], "_file string, _skip boolean")
        texts = texts.join(names, "_file", "left")
    # A filter that raises would be moved below a join that drops rows, so it decides on both.
    passed = F.col("_skip").isNotNull() if skip else F.lit(False)
    docs = texts.select(_whole_json("value").alias("_doc"), "value", passed.alias("_passed"))
    if whole:
        is_list = F.schema_of_variant("_doc").startswith("ARRAY")
        items = F.when(is_list, F.try_variant_get("_doc", "$", "array<variant>")).otherwise(F.array("_doc"))
        docs = docs.select(F.explode(items).alias("_doc"), "_passed").withColumn("value", F.to_json("_doc"))
    ok = F.coalesce(F.schema_of_variant("_doc").startswith("OBJECT"), F.lit(False))
    if strict:
        complaint = F.raise_error(F.concat(F.lit("not a JSON object: "), F.coalesce("value", F.lit("null"))))
        docs = docs.filter(F.when(F.col("_passed"), False).when(ok, True).otherwise(complaint.cast("boolean")))
    else:
        docs = docs.filter(ok & ~F.col("_passed"))
    return spread(docs.select(F.col("value").alias("_text")), F.from_json("_text", schema))


def history_schema() -> T.StructType:
    """All-text columns of the history CSV; air and weather share one file."""
    metrics = [name for spec in SPECS.values() for name in spec.history]
    return T.StructType([T.StructField(c, T.StringType()) for c in ("estacion", "fecha", "hora", *metrics)])


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """History rows as text. Columns are found by header, which may list them in any order."""
    names = spark.read.csv(path, header=True).columns
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    rows = spark.read.csv(path, header=True, schema=as_text, enforceSchema=False)
    missing = [f.name for f in history_schema() if f.name not in names]
    return rows.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def read_event_stream(
    spark: SparkSession, fmt: str = "json", options: dict[str, str] | None = None, start: str = "earliest"
) -> DataFrame:
    """A stream of ``key``, ``value`` text and the arrival number ``_seq``.

    A Kafka topic gives its offsets (one key stays in one partition, so they order its rows); files of such
    rows may carry ``seq``.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        stream = reader.option("startingOffsets", start).load().withColumnRenamed("offset", "seq")
    else:
        stream = reader.schema("key string, value string, seq long").load()
    return stream.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.coalesce(F.col("seq").cast("long"), F.lit(-1).cast("long")).alias("_seq"),
    )
