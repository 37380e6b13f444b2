"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation estimates how far to trust each.

``measure`` takes counts of a text in one numpy pass. ``VOTES`` turns them into one vote per rule: 1 good, -1 bad,
0 abstain. Rows are grouped by their pattern of votes, of which there are at most 3 to the number of rules, whatever the
size of the corpus. ``fit`` runs expectation-maximisation over the patterns: a latent good or bad text, per rule the
chance of each vote given the latent. Every pattern gets its posterior probability of good.

Toxicity is a latent of its own, as junk and abuse come independently of each other. ``fit_toxicity`` runs a second
expectation-maximisation, per language, over how many of a text's words are abusive: the terms that ``toxic_terms`` learns for
each language from a bounded sample of labels or, without labels, the fixed ``INSULTS``. A text with fewer than ``LEAST_HITS``
abusive words is not toxic, whatever its length. ``kept`` is false for texts that fail the base rules and else says whether the
chances of good by the rules and of not being toxic both reach ``threshold``.

Words are runs of characters other than ASCII white space. Null, empty and blank texts have no words, so they fail the
base rules. Repeated rows are judged alike; an empty table gives an empty one. Null ids are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base, hashing, toxic_terms
from skyledger.llm.toxic_terms import Terms

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
# Insults that count where no terms were learned, as whole words in lower case.
INSULTS = (
    "bastard clown crap cretin damn disgusting dumb fool garbage idiot imbecile jerk loser moron pathetic scum stupid trash "
    "ugly worthless"
).split()

#: Bounds of the rates of abusive words in other and in toxic texts, and of the share of toxic texts.
RATES, SHARES = ((1e-5, 2e-3), (0.01, 0.05)), (1e-3, 0.5)
#: Abusive words that it takes: a single one may be a chance likeness or a harmless use.
LEAST_HITS = 2

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_commonest", "n_insults", "n_alpha", "n_bare", "n_shouts")
MEASURE = ", ".join(f"{c}: long" for c in COUNTS)

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _per_document(n: int, owner: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights, n).astype(np.int64)


def _between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each document."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(hashing.word_hashes(data, np.array([0]), np.array([len(data)]))[0])


def counts(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray, insults: list[np.ndarray]) -> np.ndarray:
    """The COUNTS of each document of a run, one row a document; ``insults`` are keys of each group of documents."""
    n = len(offsets) - 1
    out = np.zeros((n, len(COUNTS)), np.int64)
    at = {c: i for i, c in enumerate(COUNTS)}
    starts, ends, first = hashing.word_bounds(data, offsets)
    out[:, at["n_words"]] = np.diff(first)
    out[:, at["word_chars"]] = _between(~hashing.SPACE[data] & ((data & 0xC0) != 0x80), offsets)
    out[:, at["n_symbols"]] = _between(_IS_SYMBOL[data], offsets)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    out[:, at["n_upper"]], out[:, at["n_letters"]] = _between(upper, offsets), _between(upper | lower, offsets)
    alpha = upper | lower | (data >= 0xC0)
    out[:, at["n_alpha"]] = _between(alpha, offsets)
    out[:, at["n_shouts"]] = _between((data == 0x21) | (data == 0x3F), offsets)
    if not len(starts):
        return out
    doc = hashing.owner(offsets, starts)
    seen = np.concatenate(([0], np.cumsum(alpha, dtype=np.int64)))
    out[:, at["n_bare"]] = _per_document(n, doc[seen[ends] == seen[starts]])
    salt = hashing.mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    # Lines with a word: from the first word's line start to the line's end.
    sums = hashing.prefix(hashing.CODES[data])
    breaks = np.flatnonzero(data == 10)
    cut = np.unique(np.concatenate((offsets, breaks, breaks + 1)))
    line_of = np.searchsorted(cut, starts, "right") - 1
    lines = np.unique(line_of)
    line_doc = hashing.owner(offsets, cut[lines])
    hashes = hashing.spans(sums, cut[lines], cut[lines + 1]) ^ salt[line_doc]
    _, head = np.unique(hashes, return_index=True)
    out[:, at["n_lines"]] = _per_document(n, line_doc)
    out[:, at["n_dup_lines"]] = out[:, at["n_lines"]] - _per_document(n, line_doc[head])
    # Words in windows that the document holds twice.
    words = hashing.spans(sums, starts, ends)
    k = REPEAT_WINDOW
    if len(starts) >= k:
        valid = np.flatnonzero(hashing.inside(first, k, len(starts) - k + 1))
        keys = hashing.grams(hashing.prefix(words), k)[valid] ^ salt[doc[valid]]
        _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
        twice = valid[times[place] > 1]
        edges = np.zeros(len(starts) + 1, np.int32)
        np.add.at(edges, twice, 1)
        np.add.at(edges, twice + k, -1)
        out[:, at["n_repeat_words"]] = _between(np.cumsum(edges[:-1]) > 0, first)
    # The commonest word, and insults.
    _, place, times = np.unique(words ^ salt[doc], return_inverse=True, return_counts=True)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc, times[place])
    out[:, at["n_commonest"]] = most
    out[:, at["n_insults"]] = toxic_terms.hits(data, offsets, groups, insults)
    return out


def measure(text: Column, insults: list[str] | None = None, terms: Terms | None = None, lang: Column | None = None) -> Column:
    """The counts of a text as a struct of longs; abusive words are the ``terms`` of the text's language, or without any terms the
    ``insults``."""
    fixed = np.array([_word_hash(w) for w in (INSULTS if insults is None else insults)], np.uint64) ^ toxic_terms.WHOLE
    terms = terms or Terms()
    names = ["", *[x for x in terms.langs if x]]
    known = [terms.of(x) if terms.keys else np.unique(fixed) for x in names]

    @F.arrow_udf(MEASURE)
    @base.trimmed
    def counted(texts: pa.Array, langs: pa.Array) -> pa.Array:
        data, offsets = base.flat(texts)
        group = {x: i for i, x in enumerate(names)}
        groups = np.array([group.get(x, 0) for x in langs.to_pylist()], np.int64)
        rows = [counts(d, o, groups[first:last], known) for first, last, d, o in base.chunks(data, offsets)]
        table = np.concatenate(rows) if rows else np.zeros((0, len(COUNTS)), np.int64)
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(COUNTS))], COUNTS)

    return counted(text.cast("string"), (F.lit("") if lang is None else lang).cast("string"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(m: Column) -> dict[str, Column]:
    """One vote per rule from the struct of counts; a rule abstains between its two bounds."""
    words, chars = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["word_chars"], F.lit(1))
    length = chars / words
    return {
        "symbols": _vote(m["n_symbols"] > 0.1 * words, m["n_symbols"] <= 0.02 * words),
        "repeats": _vote(m["n_repeat_words"] > 0.15 * words, m["n_repeat_words"] <= 0.02 * words),
        "lines": _vote(m["n_dup_lines"] > 0.3 * m["n_lines"], (m["n_lines"] >= 3) & (m["n_dup_lines"] == 0)),
        "capitals": _vote(m["n_upper"] > 0.5 * m["n_letters"], m["n_upper"] <= 0.2 * m["n_letters"]),
        "word_length": _vote((length < 2.5) | (length > 15), (length >= 3.5) & (length <= 10)),
        "commonest": _vote((words >= 50) & (m["n_commonest"] > 0.25 * words), m["n_commonest"] <= 0.12 * words),
        "letters": _vote(m["n_alpha"] < 0.78 * chars, m["n_alpha"] >= 0.88 * chars),
        "marked_words": _vote((m["n_symbols"] > 0.04 * chars) | (m["n_bare"] > 0.15 * words), (m["n_symbols"] <= 0.005 * chars) & (m["n_bare"] <= 0.05 * words)),
        "shouting": _vote(m["n_shouts"] > 0.25 * words, m["n_shouts"] <= 0.05 * words),
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def fit(patterns: np.ndarray, weights: np.ndarray, rounds: int = 200, accuracy: float = 0.8) -> tuple[float, np.ndarray]:
    """Expectation-maximisation: the share of good texts and ``chance[latent, rule, vote + 1]``; latent 1 is good.

    Starts from rules that are right four times in five. A rule may be found uninformative but never worse than chance:
    its bad votes are kept at least as likely for bad texts as for good ones.
    """
    n_rules = patterns.shape[1]
    prior = 0.8
    chance = np.empty((2, n_rules, 3))
    total = weights.sum()
    for r in range(n_rules):
        abstain = weights[patterns[:, r] == 0].sum() / total
        chance[1, r] = np.array([1 - accuracy, 0, accuracy]) * (1 - abstain) + np.array([0, abstain, 0])
        chance[0, r] = np.array([accuracy, 0, 1 - accuracy]) * (1 - abstain) + np.array([0, abstain, 0])
    chance = np.clip(chance, 1e-6, 1)
    for _ in range(rounds):
        good = posterior(patterns, prior, chance)
        before, prior = prior, float(np.clip((weights * good).sum() / total, 0.01, 0.99))
        for latent, share in ((1, good), (0, 1 - good)):
            w = weights * share
            for r in range(n_rules):
                found = np.array([w[patterns[:, r] == v].sum() for v in (-1, 0, 1)]) + 1e-3 * total / n_rules * np.array([0.1, 0.1, 0.1])
                chance[latent, r] = found / found.sum()
        worse = chance[1, :, 0] > chance[0, :, 0]
        mean = (chance[0] + chance[1]) / 2
        chance[:, worse] = mean[worse]
        if abs(prior - before) < 1e-9:
            break
    return prior, chance


def posterior(patterns: np.ndarray, prior: float, chance: np.ndarray) -> np.ndarray:
    """Probability of good for each pattern."""
    rules = np.arange(patterns.shape[1])
    odds = np.log(prior / (1 - prior)) + np.log(chance[1, rules, patterns + 1] / chance[0, rules, patterns + 1]).sum(1)
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def word_score(n: np.ndarray, k: np.ndarray, prior: float, low: float, high: float) -> np.ndarray:
    """Log odds of toxic for texts of ``n`` words, ``k`` of them abusive."""
    return np.log(prior / (1 - prior)) + k * np.log(high / low) - n * (high - low)


def fit_toxicity(n: np.ndarray, k: np.ndarray, weights: np.ndarray, rounds: int = 200) -> tuple[float, float, float]:
    """Expectation-maximisation: the share of toxic texts, and the rates of abusive words in other and in toxic ones.

    Words and abusive words are means of groups of ``weights`` texts; counts are taken as Poisson. The rates stay within
    ``RATES``, so that neither a few texts of nothing but insults nor a corpus without any moves the line between the two.
    """
    prior, low, high = 0.1, 5e-4, 0.02
    total = weights.sum()
    for _ in range(rounds):
        toxic = 1 / (1 + np.exp(-np.clip(word_score(n, k, prior, low, high), -60, 60)))
        before = prior
        bad, rest = weights * toxic, weights * (1 - toxic)
        prior = float(np.clip(bad.sum() / total, *SHARES))
        low = float(np.clip((rest * k).sum() / max((rest * n).sum(), 1), *RATES[0]))
        if bad.sum() > 1:
            high = float(np.clip((bad * k).sum() / (bad * n).sum(), *RATES[1]))
        if abs(prior - before) < 1e-9:
            break
    return prior, low, high


def judged(
    docs: DataFrame, text_col: str = "text", threshold: float = 0.5, terms: Terms | None = None, lang_col: str | None = None
) -> DataFrame:
    """The columns of ``docs``, with ``_m`` (counts), ``_failed``, ``_good`` (the lower of the posteriors of good by the rules
    and of not toxic) and ``_kept``, which replace columns of these names.

    Reads the texts twice: for the patterns of votes and the groups of counts, and for the result.
    """
    base.prepare(docs.sparkSession)
    text, terms = F.col(f"`{text_col}`"), terms or Terms()
    known = [x for x in terms.langs if x]
    lang = F.lit("") if lang_col is None else F.col(f"`{lang_col}`").cast("string")
    lang = F.when(lang.isin(known), lang).otherwise("") if known else F.lit("")
    m = F.col("_m")
    measured = docs.select(lang.alias("lang"), measure(text, terms=terms, lang=lang).alias("_m"))
    cast = [v.cast("int").alias(k) for k, v in votes(m).items()]
    names = list(votes(m))
    # A filter on the counts would take them a second time below the votes, so failed texts go as a group. Lengths and
    # numbers of abusive words go in steps of a quarter of an octave, the latter one by one up to 16.
    step = lambda c: F.floor(4 * F.log2(F.greatest(c, F.lit(1)).cast("double")))
    few = F.when(m["n_insults"] <= 16, m["n_insults"]).otherwise(step(m["n_insults"]))
    groups = measured.select(
        base_failed(m).alias("failed"), "lang", *cast, step(m["n_words"]).alias("long"), few.alias("abusive"), m["n_words"].alias("words"),
        m["n_insults"].alias("insults"),
    )
    sums = [F.count("*").alias("n"), F.sum("words").alias("words"), F.sum("insults").alias("insults")]
    groups = base.stored(groups.groupBy("failed", "lang", "long", "abusive", *names).agg(*sums), "votes").filter("NOT failed")
    rows = sorted(tuple(r) for r in groups.groupBy(*names).agg(F.sum("n").alias("n")).collect())  # at most 3 ** rules
    lengths = groups.groupBy("lang", "long", "abusive").agg(*[F.sum(c).alias(c) for c in ("n", "words", "insults")]).collect()
    out = docs.withColumn("_m", measure(text, terms=terms, lang=lang)).withColumn("_failed", base_failed(m))
    good = F.lit(0.0)
    if rows:
        patterns = np.array([r[:-1] for r in rows], np.int64)
        prior, chance = fit(patterns, np.array([r[-1] for r in rows], float))
        score = [F.lit(float(np.log(prior / (1 - prior))))]
        for r, vote in enumerate(votes(m).values()):
            ratio = np.log(chance[1, r] / chance[0, r])
            score.append(F.when(vote < 0, float(ratio[0])).when(vote > 0, float(ratio[2])).otherwise(float(ratio[1])))
        odds = score[0]
        for s in score[1:]:
            odds = odds + s
        good = 1 / (1 + F.exp(-odds))
        clean = F.lit(1.0)
        for x in sorted({r["lang"] for r in lengths}):
            w, n, k = np.array(sorted((r["n"], r["words"] / r["n"], r["insults"] / r["n"]) for r in lengths if r["lang"] == x), float).T
            share, low, high = fit_toxicity(n, k, w)
            toxic = F.lit(float(np.log(share / (1 - share)))) + m["n_insults"] * float(np.log(high / low)) - m["n_words"] * (high - low)
            clean = F.when((lang == x) & (m["n_insults"] >= LEAST_HITS), 1 / (1 + F.exp(toxic))).otherwise(clean)
        good = F.least(good, clean)
    out = out.withColumn("_good", F.when(F.col("_failed"), 0.0).otherwise(good))
    return out.withColumn("_kept", ~F.col("_failed") & (F.col("_good") >= threshold))


def keep_good(
    docs: DataFrame, text_col: str = "text", threshold: float = 0.5, labels: DataFrame | None = None, id_col: str = "doc_id", lang_col: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns; ``labels`` ``(doc_id, toxic)`` tell abusive terms."""
    lang = F.col(f"`{lang_col}`") if lang_col in docs.columns else None
    terms = None if labels is None else toxic_terms.learn(docs, labels, F.col("toxic") == 1, lang, id_col, text_col)
    names = {"text": text_col} | ({"lang": lang_col} if lang is not None else {})
    return judged(base.packed(docs, **names), "text", threshold, terms, None if lang is None else "lang").filter("_kept").select("row.*")
