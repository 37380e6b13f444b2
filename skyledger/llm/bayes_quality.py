"""Quality by hierarchical empirical Bayes: a document's own evidence on top of what its path and host are like.

1. A logistic regression on ratios of counts (``weak_supervision.measure``) gives each document's evidence. It is trained
   in numpy on at most about ``SAMPLE`` labelled documents, chosen by a hash of their id. Among the counts is that of abusive
   words beyond the first: hashed words and word beginnings that ``toxic_terms`` learns for each language from a bounded
   sample of the same labels.
2. Sums of the evidence per host and per path within a host are partial aggregates. The spread between hosts beyond what
   chance explains gives, by the method of moments, how many documents a host's prior is worth, and likewise for paths.
   A host's posterior is shrunk to the global rate, a path's to its host's: sparse sites stay near their prior.
3. A document's posterior adds its evidence to the log odds of its path, from which the document itself is left out.

Only those few moments and the sample reach the driver. Null hosts and paths are sites of their own; null, empty and blank
texts have the counts of an empty text. Rows without a label, or with a null one, are judged but not learned from; without
any labelled row evidence is 0.5 everywhere. Repeated rows count each; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base, toxic_terms
from skyledger.llm.weak_supervision import measure

SAMPLE, RIDGE = 20_000, 1.0
#: Bounds of the documents that a prior is worth, and of probabilities in log odds.
LEAST_WORTH, MOST_WORTH, EDGE = 1.0, 1e6, 1e-4


def ratios(m: Column) -> list[Column]:
    """What the regression sees of a text."""
    words, chars = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["word_chars"], F.lit(1))
    share = lambda c, of, top=1.0: F.least(m[c] / of, F.lit(top)).cast("double")
    length = (chars / words).cast("double")
    # The first abusive word may be a chance likeness; it tells nothing by itself.
    abusive = F.greatest(m["n_insults"] - 1, F.lit(0))
    among = lambda of: F.least(abusive / of, F.lit(1.0)).cast("double")
    return [
        share("n_symbols", words, 2.0),
        share("n_symbols", chars),
        share("n_repeat_words", words),
        share("n_dup_lines", F.greatest(m["n_lines"], F.lit(1))),
        share("n_upper", F.greatest(m["n_letters"], F.lit(1))),
        share("n_commonest", words),
        F.sqrt(among(words)),
        among(0.01 * words),
        (abusive > 0).cast("double"),
        share("n_alpha", chars, 1.0),
        share("n_bare", words),
        share("n_shouts", words, 2.0),
        F.least(F.abs(length - 6), F.lit(20.0)),
        F.log1p(m["n_words"].cast("double")),
        (m["n_words"] < 5).cast("double"),
    ]


def train(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge, by Newton steps on standardised columns; weights for the raw columns."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = RIDGE * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    raw = w[:-1] / scale
    return raw, float(w[-1] - raw @ mean)


def worth(rate: float, spread: float, noise: float) -> float:
    """Documents that a prior is worth: sites that differ no more than chance explains share it fully."""
    between = spread - noise
    if between <= 0 or rate <= 0 or rate >= 1:
        return MOST_WORTH
    return float(np.clip(rate * (1 - rate) / between - 1, LEAST_WORTH, MOST_WORTH))


def log_odds(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - EDGE)), F.lit(EDGE))
    return F.log(p / (1 - p))


def _between(sites: DataFrame, above: Column) -> tuple[float, float]:
    """Spread of site means around the level above, and how much of it chance explains; sites weigh by documents."""
    mean = F.col("s") / F.col("n")
    within = F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0))
    row = sites.filter("n > 1").agg(
        F.sum(F.col("n") * (mean - above) ** 2).alias("spread"), F.sum(F.col("n") * within / (F.col("n") - 1)).alias("noise"), F.sum("n").alias("n")
    ).first()
    return (row["spread"] / row["n"], row["noise"] / row["n"]) if row["n"] else (0.0, 0.0)


def posteriors(scored: DataFrame) -> DataFrame:
    """``(doc_id, p_doc, p_host, p_path, p_good)`` from rows ``(doc_id, host, path, p_doc, evidence)``."""
    paths = base.stored(
        scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p_doc").alias("s"), F.sum(F.col("p_doc") ** 2).alias("q")), "paths"
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    rate = total["s"] / total["n"] if total["n"] else 0.5
    host_worth = worth(rate, *_between(hosts, F.lit(rate)))
    known = hosts.select("host", ((rate * host_worth + F.col("s")) / (host_worth + F.col("n"))).alias("p_host"))
    sites = paths.join(known, "host")
    path_worth = worth(rate, *_between(sites, F.col("p_host")))
    sites = sites.select("host", "path", "n", "s", "p_host")
    each = scored.join(sites, ["host", "path"])
    rest = (path_worth * F.col("p_host") + F.col("s") - F.col("p_doc")) / (path_worth + F.col("n") - 1)
    return each.select(
        "doc_id", "p_doc", "p_host", ((path_worth * F.col("p_host") + F.col("s")) / (path_worth + F.col("n"))).alias("p_path"),
        (1 / (1 + F.exp(-(log_odds(rest) + F.col("evidence"))))).alias("p_good"),
    )


def judged(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, good: Column, id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE, toxic: Column | None = None, lang: Column | None = None,
) -> DataFrame:
    """``(doc_id, p_doc, p_host, p_path, p_good)`` per row of ``docs``; ``good`` is a condition on the columns of ``labels``, as
    is ``toxic`` (not good, if it isn't given), from which the terms of each ``lang`` are learned."""
    base.prepare(docs.sparkSession)
    terms = toxic_terms.learn(docs, labels, ~good if toxic is None else toxic, lang, id_col, text_col)
    name = lambda c: F.coalesce(c.cast("string"), F.lit("\0"))
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), name(host).alias("host"), name(path).alias("path"), measure(F.col(f"`{text_col}`"), terms=terms, lang=lang).alias("_m"))
    seen = base.stored(found.select("doc_id", "host", "path", F.array(*ratios(F.col("_m"))).alias("x")), "ratios")
    marked = labels.select(F.col(f"`{id_col}`").alias("doc_id"), good.cast("double").alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
    n = marked.count()
    if n > sample:
        marked = marked.filter(F.xxhash64("doc_id") <= int(2**64 * (sample / n)) - 2**63)
    rows = sorted((r["doc_id"], r["y"], tuple(r["x"])) for r in seen.join(marked, "doc_id").select("doc_id", "y", "x").collect())
    evidence = F.lit(0.0)
    prior = 0.5
    if rows and len({r[1] for r in rows}) == 2:
        y = np.array([r[1] for r in rows])
        weights, shift = train(np.array([r[2] for r in rows]), y)
        prior = float(y.mean())
        evidence = F.lit(shift)
        for i, w in enumerate(weights.tolist()):
            evidence = evidence + F.lit(w) * F.col("x")[i]
    odds = F.greatest(F.least(evidence, F.lit(30.0)), F.lit(-30.0))
    base_odds = float(np.log(prior / (1 - prior)))
    scored = seen.select("doc_id", "host", "path", (1 / (1 + F.exp(-odds))).alias("p_doc"), (odds - base_odds).alias("evidence"))
    return posteriors(base.stored(scored, "scored"))
