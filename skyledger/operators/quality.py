"""Validation, quarantine, freshness and alert routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.once import bound
from skyledger.functions.time import ISO_INSTANT, before, instant, interval_seconds
from skyledger.sources.files import exists, list_names, remove, replace_text
from skyledger.spec import DatasetSpec
from skyledger.session import literal_table

NUMBER_TYPES = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


def with_validation_errors(
    df: DataFrame, spec: DatasetSpec, value: str = "value", strict: bool = False, name: str = "errors"
) -> DataFrame:
    """Adds all schema violations of one JSON text as ``path: message``; an empty array means valid.

    Types are those written in the JSON, so ``5`` and ``"5"`` differ. Unknown fields are allowed. Strict
    mode also requires the instant to be ISO-8601. Each text is parsed once, each field looked up once.
    """
    metrics = [c for c in dict.fromkeys(spec.renames.values()) if c not in spec.texts]
    rules = {spec.key: ["string"], spec.ts: ["string"]}
    rules |= {c: ["number", "null"] for c in metrics}
    rules |= {c: ["string", "null"] for c in spec.texts}
    rules |= {c: ["number", "null"] for c in spec.places}

    def judge(doc: Column) -> Column:
        fields = F.struct(*[F.try_variant_get(doc, f"$.{c}", "variant").alias(c) for c in rules])
        return bound(fields, lambda field: bound(kinds(doc, field), lambda kind: verdict(doc, field, kind)))

    def kinds(doc: Column, field: Column) -> Column:
        named = [F.schema_of_variant(field[c]).alias(c) for c in rules]
        return F.struct(F.schema_of_variant(doc).alias("(root)"), *named)

    def mismatch(name: str, value: Column, kind: Column) -> Column:
        tests = {"string": kind == "STRING", "number": kind.rlike(NUMBER_TYPES), "null": kind == "VOID"}
        ok = F.lit(False)
        for want in rules[name]:
            ok = ok | tests[want]
        names = ", ".join(f"'{a}'" for a in rules[name])
        return F.when(
            kind.isNotNull() & ~ok, F.concat(F.lit(f"{name}: "), _shown(value, kind), F.lit(f" is not of type {names}"))
        )

    def verdict(doc: Column, field: Column, kind: Column) -> Column:
        found = [mismatch(c, field[c], kind[c]) for c in rules]
        if strict:
            at = field[spec.ts]
            odd = (kind[spec.ts] == "STRING") & ~F.try_variant_get(at, "$", "string").rlike(ISO_INSTANT)
            message = F.concat(F.lit(f"{spec.ts}: "), _shown(at, kind[spec.ts]), F.lit(" is not a 'date-time'"))
            found.insert(2, F.when(odd, message))
        for c in (spec.key, spec.ts):
            found.append(F.when(kind[c].isNull(), F.lit(f"(root): '{c}' is a required property")))
        root = kind["(root)"]
        not_object = F.concat(F.lit("(root): "), _shown(doc, root), F.lit(" is not of type 'object'"))
        return (
            F.when(root.isNull(), F.array(F.lit("(root): invalid JSON")))
            .when(~root.startswith("OBJECT"), F.array(not_object))
            .otherwise(F.array_compact(F.array(*found)))
        )

    return df.withColumn(name, bound(F.try_parse_json(value), judge))


def _shown(doc: Column, kind: Column) -> Column:
    """A value as it reads in messages: quoted text, True, False, None, or the JSON itself."""
    body = F.try_variant_get(doc, "$", "string")
    escaped = F.replace(F.replace(body, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    quote = F.when(F.contains(body, F.lit("'")) & ~F.contains(body, F.lit('"')), F.lit('"')).otherwise(F.lit("'"))
    return (
        F.when(kind == "STRING", F.concat(quote, escaped, quote))
        .when(kind == "BOOLEAN", F.initcap(body))
        .when(kind == "VOID", F.lit("None"))
        .otherwise(body)
    )


def validate(
    df: DataFrame, spec: DatasetSpec, value: str = "value", strict: bool = False, index: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Valid rows, rejected rows with their ``errors``, and one row of counts.

    With an ``index`` column each message is prefixed ``Record <index>: ``.
    """
    judged = with_validation_errors(df, spec, value, strict)
    if index:
        prefix = F.concat(F.lit("Record "), F.col(index).cast("string"), F.lit(": "))
        judged = judged.withColumn("errors", F.transform("errors", lambda e: F.concat(prefix, e)))
    bad = F.size("errors") > 0
    counts = judged.agg(
        F.count_if(~bad).alias("valid_count"),
        F.count_if(bad).alias("invalid_count"),
        F.sum(F.size("errors")).alias("error_count"),
    )
    return judged.filter(~bad).drop("errors"), judged.filter(bad), counts


class FailedBatch(int):
    """A batch number that knows its writer, as numbers of several writers repeat."""

    writer: str

    def __new__(cls, number: int, writer: str = "") -> FailedBatch:
        batch = super().__new__(cls, number)
        batch.writer = writer
        return batch

    @property
    def folder(self) -> str:
        return f"writer={self.writer}/batch_id={int(self)}" if self.writer else f"batch_id={int(self)}"


def quarantine(df: DataFrame, path: str, batch_id: int, ts: Column | None = None, writer: str = "") -> None:
    """Keep failed ``key, value`` rows under their writer and batch; writing a batch again replaces it, unless its rows have
    been handed on already. A streaming writer is named by its query's id, which a new checkpoint changes."""
    batch = FailedBatch(batch_id, writer)
    if exists(df.sparkSession, f"{path}/consumed/{batch.folder}"):
        return
    kept = df.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        (F.current_timestamp() if ts is None else ts).cast("timestamp").alias("ts"),
    )
    kept.write.mode("overwrite").parquet(f"{path}/failed/{batch.folder}")


def requeue(spark: SparkSession, path: str) -> tuple[DataFrame, list[FailedBatch]]:
    """All failed rows not yet handed on, and the batches they come from."""
    found = []
    for name in list_names(spark, f"{path}/failed"):
        if name.startswith("batch_id="):
            found.append(FailedBatch(int(name[9:])))
        elif name.startswith("writer="):
            found += [FailedBatch(int(n[9:]), name[7:]) for n in list_names(spark, f"{path}/failed/{name}") if n.startswith("batch_id=")]
    waiting = sorted((b for b in found if not exists(spark, f"{path}/consumed/{b.folder}")), key=lambda b: (b.writer, int(b)))
    schema = "key string, value string, ts timestamp"
    if not waiting:
        return literal_table(spark, [], schema), []
    folders = [f"{path}/failed/{b.folder}" for b in waiting]
    return spark.read.schema(schema).parquet(*folders), waiting


def mark_consumed(spark: SparkSession, path: str, batches: Sequence[int]) -> None:
    """Call after the next stage has safely written the requeued rows. Their folders go, so a later ``requeue`` lists only what
    waits; an empty file remembers the batch, should its writer run it again."""
    for batch in batches:
        batch = batch if isinstance(batch, FailedBatch) else FailedBatch(batch)
        replace_text(spark, f"{path}/consumed/{batch.folder}", "")
        remove(spark, f"{path}/failed/{batch.folder}")


def read_dead_letters(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a JSON-lines queue, malformed lines skipped; and its size in non-blank lines."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.withColumn("_doc", F.try_parse_json("value")).filter(
        F.schema_of_variant("_doc").startswith("OBJECT")
    )
    rows = parsed.select(
        F.coalesce(F.try_variant_get("_doc", "$.key", "string"), F.lit("")).alias("key"),
        F.coalesce(F.try_variant_get("_doc", "$.value", "string"), F.lit("")).alias("value"),
        F.timestamp_seconds(F.try_variant_get("_doc", "$.ts", "double")).alias("ts"),
    )
    return rows, lines.agg(F.count(F.lit(1)).alias("size"))


def freshness(
    df: DataFrame,
    expected: DataFrame,
    as_of=None,
    window="30 minutes",
    hold="30 minutes",
    dataset: str = "dataset",
    ts: str = "ts",
    weight: str | None = None,
) -> DataFrame:
    """Per expected dataset: rows in the window, and ``ok``, ``pending`` or ``firing``.

    ``weight`` names a column that says how many rows each row stands for.

    An alert fires once the window has been empty for ``hold``, so only the last ``window + hold`` is read.
    """
    total = interval_seconds(window) + interval_seconds(hold)
    recent = df.filter((F.col(ts) > before(as_of, total)) & (F.col(ts) <= instant(as_of)))
    counts = recent.groupBy(dataset).agg(
        F.coalesce(F.sum(F.when(F.col(ts) > before(as_of, window), F.col(weight) if weight else F.lit(1))), F.lit(0)).cast("long").alias("_rows"),
        F.max(ts).alias("last_ts"),
    )
    state = F.when(F.col("_rows") > 0, "ok").when(F.col("last_ts").isNotNull(), "pending").otherwise("firing")
    return expected.select(dataset).distinct().join(counts, dataset, "left").select(
        dataset, F.coalesce("_rows", F.lit(0).cast("long")).alias("rows_in_window"), state.alias("state")
    )


def group_alerts(alerts: DataFrame, ts: str = "ts") -> DataFrame:
    """One row per alert name and severity."""
    return alerts.groupBy("alertname", "severity").agg(
        F.count(F.lit(1)).alias("alerts"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def inhibit(alerts: DataFrame) -> DataFrame:
    """Warnings are dropped while a critical alert of the same name exists."""
    critical = alerts.filter(F.col("severity") == "critical").select("alertname").distinct()
    quiet = critical.withColumn("severity", F.lit("warning"))
    return alerts.join(quiet, ["alertname", "severity"], "left_anti")


def load_report(df: DataFrame, loaded: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows loaded and skipped."""
    ok = F.coalesce(loaded, F.lit(False))
    return df.groupBy(*by).agg(F.count_if(ok).alias("loaded"), F.count_if(~ok).alias("skipped"))
