"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its byte n-grams, hashed into a fixed table; embeddings and the linear layer
are trained by stochastic gradient descent in numpy on a bounded sample: about ``sample`` labelled documents a language,
chosen by a hash of their id, whose n-gram counts are taken on the executors. A prediction multiplies both layers out
beforehand, so a text costs one table row per n-gram. A temperature fitted on a held-back part of the sample calibrates
the score, and ``accept`` is the least score at which held-back predictions were right as often as asked.

Texts that are null or hold no letter are ``und`` with score 0. Null labels and null ids are never learned from. Without
any labelled row every text is ``und``. Repeated rows are predicted alike; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base, hashing

BUCKETS, WIDTH, GRAMS = 1 << 15, 16, (1, 2, 3, 4)
#: Sampled documents a language, and passes over them.
SAMPLE, EPOCHS = 600, 6
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    langs: list[str]
    table: np.ndarray  # n-gram bucket to logits
    temperature: float
    accept: float


def gram_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all n-grams of a run of documents, and the document of each."""
    data = hashing.lowered(data)
    found, docs = [], []
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    code = np.zeros(len(data), np.uint32)
    for size in range(1, max(GRAMS) + 1):
        n = len(data) - size + 1
        if n <= 0:
            break
        code = code[:n] * np.uint32(257) + data[size - 1 :]
        if size in GRAMS:
            whole = owner[:n] == owner[size - 1 :]
            mixed = (code + np.uint32(size)) * np.uint32(0x9E3779B1)
            found.append(((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(17))[whole] % np.uint32(buckets))
            docs.append(owner[:n][whole])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found).astype(np.int64), np.concatenate(docs)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its distinct buckets and their counts."""
    for batch in batches:
        data, offsets = base.flat(batch.column("text"))
        at, n = [], []
        for _, _, d, o in base.chunks(data, offsets):
            bucket, doc = gram_buckets(d, o)
            for i in range(len(o) - 1):
                seen, times = np.unique(bucket[doc == i] if len(o) > 2 else bucket, return_counts=True)
                at.append(seen.astype(np.int32).tobytes())
                n.append(times.astype(np.int32).tobytes())
        yield pa.record_batch([batch.column("lang"), batch.column("h"), base.binary_column(at), base.binary_column(n)], names=["lang", "h", "at", "n"])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], n_langs: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings and linear layer by SGD, one document at a time; rows are ``(label, buckets, counts)``."""
    rng = np.random.default_rng(seed)
    embed, linear = rng.normal(0, 0.1, (BUCKETS, WIDTH)), rng.normal(0, 0.1, (WIDTH, n_langs))
    steps, total = 0, max(1, len(rows) * EPOCHS)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            label, at, n = rows[i]
            rate = 0.5 * (1 - steps / total)
            steps += 1
            if not len(at):
                continue
            share = n / n.sum()
            mean = share @ embed[at]
            error = softmax(mean @ linear)
            error[label] -= 1
            back = linear @ error
            linear -= rate * np.outer(mean, error)
            embed[at] -= (rate * 40) * np.outer(share, back)
    return embed, linear


def calibrate(logits: np.ndarray, labels: np.ndarray, precision: float) -> tuple[float, float]:
    """The temperature of least log loss, and the least score above which predictions are right often enough."""
    if not len(labels):
        return 1.0, 0.0
    grid = np.geomspace(0.02, 5, 80)
    loss = [-np.log(np.clip(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12, 1)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(logits / temperature)
    score, right = p.max(1), p.argmax(1) == labels
    order = np.argsort(-score, kind="stable")
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    return temperature, float(score[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0


def fit(labelled: DataFrame, sample: int = SAMPLE, precision: float = 0.99) -> Model:
    """Train on rows ``(doc_id, text, lang)``; only the sample's n-gram counts reach the driver."""
    base.prepare(labelled.sparkSession)
    rows = labelled.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").withColumn("h", F.xxhash64("doc_id"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), 1.0, 0.0)
    part = F.lit(False)
    for lang in langs:
        bound = min(2**63 - 1, int(2**64 * min(1.0, sample / sizes[lang])) - 2**63)
        part = part | ((F.col("lang") == lang) & (F.col("h") <= bound))
    got = rows.filter(part).select("lang", "h", "text").mapInArrow(_features, "lang string, h long, at binary, n binary").collect()
    data = sorted((langs.index(r["lang"]), r["h"], bytes(r["at"]), bytes(r["n"])) for r in got)
    data = [(y, h, np.frombuffer(a, np.int32), np.frombuffer(n, np.int32)) for y, h, a, n in data]
    held = [x for x in data if x[1] % 5 == 0]
    embed, linear = train([(y, a, n) for y, h, a, n in data if h % 5], len(langs))
    table = (embed @ linear).astype(np.float32)
    logits = np.array([(n / max(1, n.sum())) @ table[a] for _, _, a, n in held]).reshape(len(held), len(langs))
    temperature, accept = calibrate(logits, np.array([y for y, *_ in held], int), precision)
    return Model(langs, table, temperature, accept)


def predict(text: Column, model: Model) -> Column:
    """``struct<lang, score>`` of a text."""
    langs, table, temperature = model.langs, model.table, model.temperature

    @F.arrow_udf("lang: string, score: double")
    @base.trimmed
    def predicted(texts: pa.Array) -> pa.Array:
        data, offsets = base.flat(texts)
        n = len(offsets) - 1
        logits = np.zeros((n, len(langs)))
        for first, last, d, o in base.chunks(data, offsets, base.CHUNK_BYTES):
            bucket, doc = gram_buckets(d, o)
            times = np.maximum(np.bincount(doc, minlength=last - first), 1)
            for j in range(len(langs)):
                logits[first:last, j] = np.bincount(doc, table[bucket, j], last - first) / times
        p = softmax(logits / temperature) if len(langs) else np.zeros((n, 1))
        best = p.argmax(1) if n else np.zeros(0, int)
        names = pa.array([langs[i] for i in best] if langs else [UNKNOWN] * n, pa.string())
        return pa.StructArray.from_arrays([names, pa.array(p.max(1) if n else np.zeros(0))], ["lang", "score"])

    letters = text.isNotNull() & text.rlike(r"\p{L}")
    none = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if not langs:
        return none
    return F.when(letters, predicted(text)).otherwise(none)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``_lang``, ``_score`` and ``_accepted``, which replace columns of these names."""
    base.prepare(docs.sparkSession)
    out = base.packed(docs, text=text_col).withColumn("_p", predict(F.col("text").cast("string"), model))
    return out.select(
        *[F.col(f"row.`{c}`") for c in docs.columns if c not in ("_lang", "_score", "_accepted")],
        F.col("_p.lang").alias("_lang"),
        F.col("_p.score").alias("_score"),
        ((F.col("_p.lang") != UNKNOWN) & (F.col("_p.score") >= model.accept)).alias("_accepted"),
    )
