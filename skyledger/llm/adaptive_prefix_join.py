"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

A document's set holds the 64-bit hashes of its distinct shingles. Sets are ordered rare first by document frequencies
counted over the whole corpus (``blocks``); shingles of one document need never be sent. Equal sets are one class.

Two sets that must share ``o`` tokens to be similar share at least ``l`` of their first ``n - o + l``, for every ``l``.
Each class picks the ``l`` whose prefix is cheapest by its estimate of postings read and candidates verified
(``choose_length``); a pair is a candidate if it shares as many prefix tokens as the larger set asks for. Postings are
kept for the least ``o`` that any partner allows, and a pair's own ``o`` shortens its prefixes further.

A pair shares at most the tokens of either set that other documents hold, which is known of each (``shared``), so pairs
that can't be similar by that bound are not formed. A posting list is never multiplied with itself as long as its documents may be joined by fewer links:

1. every class is verified against the leader it shares most prefix tokens with; a list is led by the member whose own
   tokens are the most frequent, which in a family of near copies is the text nearest to their common source,
2. pairs of short lists are counted as they are; of a long list, pairs of classes that step 1 left in different
   components, where one of the two is outside the list's largest component; tokens of FREQUENT documents or more never
   meet in one task: their postings are plain rows, led by a partially aggregated maximum and joined under salts,
3. pairs with enough shared tokens and different components are verified, so no link between components is missed.

Component ids are the smallest document id reachable. Null ids stand alone with a null component; rows of one id are
one document. Texts that are null, empty or without words have no shingles and link with nothing; repeated texts are one
class; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import base, blocks, hashing
from skyledger.llm.components import components

SHINGLE, PERCENT = 5, 75
#: Longest extension of a prefix; lists up to SHORT are paired off at once; weights of a posting and of a verified token.
MAX_LENGTH, SHORT = 4, 24
POSTING_COST, TOKEN_COST = 4.0, 0.05
KEY_BITS = 30
POSTINGS_PER_BUCKET = 1 << 18
#: Tokens of so many documents are kept out of buckets; rows of one such token that a task gets, about.
FREQUENT, SALT_ROWS = 1 << 12, 1 << 14


def document_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    for _, _, d, o in base.chunks(data, offsets):
        d = hashing.lowered(d)
        starts, ends, first = hashing.word_bounds(d, o)
        if not len(starts):
            yield from (np.zeros(0, np.uint64) for _ in range(len(o) - 1))
            continue
        sums = hashing.prefix(hashing.word_hashes(d, starts, ends))
        at = np.arange(max(0, len(starts) - shingle + 1))
        hashes = hashing.spans(sums, at, at + shingle) if len(at) else np.zeros(0, np.uint64)
        for s, e in zip(first[:-1], first[1:]):
            if e - s >= shingle:
                yield np.unique(hashes[s : e - shingle + 1])
            elif e > s:
                yield hashing.spans(sums, np.array([s]), np.array([e]))
            else:
                yield np.zeros(0, np.uint64)


def class_key(tokens: np.ndarray) -> int:
    """One 64-bit number for a set; equal sets have equal keys."""
    with np.errstate(over="ignore"):
        total = hashing.mix(tokens).sum(dtype=np.uint64)
    return int(hashing.mix(np.array([total + np.uint64(len(tokens))]))[0])


def _sets(table: pa.Table, shingle: int) -> list[np.ndarray]:
    return list(document_sets(*base.flat(table.column("text")), shingle))


def _block_keys(sets: list[np.ndarray], kept: int) -> tuple[np.ndarray, np.ndarray]:
    drop = np.uint64(64 - kept)
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return np.unique((every >> drop) << drop, return_counts=True)


def _class_keys(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([class_key(s) for s in sets], np.uint64)


def _send_keys(shingle: int, bits: int):
    kept = min(64, bits + KEY_BITS)

    def keys(table: pa.Table) -> pa.Table:
        sets = _sets(table, shingle)
        blk = table.column("blk")[0].as_py()
        distinct, counts = _block_keys(sets, kept)
        owned = np.unique(_class_keys([s for s in sets if len(s)]))
        own = blocks.send(blk, owned, np.zeros(len(owned), "<u2"), bits)
        own = own.set_column(1, "bucket", pa.array(own.column("bucket").to_numpy() + (1 << bits)))
        return pa.Table.from_batches([blocks.send(blk, distinct, np.minimum(counts, 65535).astype("<u2"), bits, kept), own])

    return keys


def _answer_keys(bits: int):
    def judge(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 1 << bits:
            return blocks.answer(_frequency_class, "<u2", table)
        order = np.argsort(table.column("blk").to_numpy(), kind="stable")
        return blocks.answer(_first_block, "<u2", table.take(pa.array(order)))

    return judge


def _frequency_class(group: np.ndarray, vals: np.ndarray, n: int) -> np.ndarray:
    """Four steps a doubling; 0 for a token of one document."""
    total = np.bincount(group, vals, n)
    return np.floor(4 * np.log2(total) + 1e-9).clip(0, 255).astype(np.uint8)[group]


def _first_block(group: np.ndarray, vals: np.ndarray, n: int) -> np.ndarray:
    """Whether a block is the first that sent the key."""
    said = np.zeros(len(group), np.uint8)
    said[np.unique(group, return_index=True)[1]] = 1
    return said


SETS = "doc_id long, h long, n_shingles long, cls long, tokens binary, rarity binary"


def _ordered_sets(shingle: int, percent: int, bits: int):
    """Per document its class if it may have a link; the set itself once per class, rare tokens first."""
    kept = min(64, bits + KEY_BITS)

    def build(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return base.empty(doc_id=pa.int64(), h=pa.int64(), n_shingles=pa.int64(), cls=pa.int64(), tokens=pa.binary(), rarity=pa.binary())
        sets = _sets(table, shingle)
        said = blocks.told(answers, "u1")
        distinct, _ = _block_keys(sets, kept)
        keys = _class_keys(sets)
        filled = np.array([len(s) > 0 for s in sets])
        classes = np.unique(keys[filled])
        owned = said[len(distinct) :].astype(bool)
        drop = np.uint64(64 - kept)
        cls, tokens, rarity, written = [], [], [], set()
        for s, key in zip(sets, keys.tolist()):
            seen = said[np.searchsorted(distinct, (s >> drop) << drop)] if len(s) else np.zeros(0, np.uint8)
            if not len(s) or 100 * int((seen > 0).sum()) < percent * len(s):
                cls.append(None), tokens.append(None), rarity.append(None)
                continue
            cls.append(int(np.uint64(key).astype(np.int64)))
            if key not in written and owned[np.searchsorted(classes, np.uint64(key))]:
                written.add(key)
                order = np.lexsort((s, seen))
                tokens.append(s[order].tobytes())
                rarity.append(seen[order].tobytes())
            else:
                tokens.append(None), rarity.append(None)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "h": table.column("h"),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "cls": pa.array(cls, pa.int64()),
                "tokens": pa.array(tokens, pa.binary()),
                "rarity": pa.array(rarity, pa.binary()),
            }
        )

    return build


#: What goes with a posting, in order, and its type.
POSTING = {"token": np.uint64, "rank": np.int32, "cls": np.int64, "size": np.int32, "shared": np.int32, "weight": np.float32, "length": np.uint8}


def choose_length(size: int, need: int, rarity: np.ndarray) -> int:
    """How many shared prefix tokens to ask for: the fewest expected postings and verified tokens."""
    frequency = np.where(rarity > 0, 2.0 ** (rarity / 4.0), 0.0)
    read = np.cumsum(frequency)
    costs = []
    for length in range(1, min(MAX_LENGTH, need) + 1):
        postings = read[size - need + length - 1]
        costs.append(POSTING_COST * postings + TOKEN_COST * size * postings / length)
    return 1 + int(np.argmin(costs))


def prefix_end(size, percent: int):
    """How many tokens of a set the longest prefix holds; numbers or columns."""
    if isinstance(size, int):
        return min(size, size - -(-percent * size // 100) + MAX_LENGTH)
    return F.least(size, size - F.ceil(percent * size / 100) + MAX_LENGTH).cast("int")


def frequency_step(documents: int) -> int:
    """The least frequency class whose tokens may be in so many documents."""
    return int(np.floor(4 * np.log2(documents) + 1e-9))


def _prefixes(batch: pa.RecordBatch, percent: int, least: int, below: int) -> list[tuple[np.ndarray, ...]]:
    """Per class the columns of POSTING, and the frequency classes, of prefix tokens with ``least <= class < below``."""
    rows = []
    for cls, token, rare in zip(*[batch.column(c).to_pylist() for c in ("cls", "tokens", "rarity")]):
        t, r = np.frombuffer(token, np.uint64), np.frombuffer(rare, np.uint8)
        length = choose_length(len(t), -(-percent * len(t) // 100), r)
        told = r[: prefix_end(len(t), percent)]
        rank = np.flatnonzero((told >= least) & (told < below))
        same = [(cls, np.int64), (len(t), np.int32), (int((r > 0).sum()), np.int32), (r.mean(dtype=np.float64) if len(r) else 0, np.float32), (length, np.uint8)]
        rows.append((t[rank], (rank + 1).astype(np.int32), *[np.full(len(rank), value, kind) for value, kind in same], r[rank]))
    return rows


def _postings(percent: int, n_buckets: int, below: int):
    """Prefix tokens of several documents, as blobs by token bucket, with what a list needs to know of its members."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _prefixes(batch, percent, 1, below)
            if not rows:
                continue
            every = [np.concatenate(x) for x in zip(*rows)][: len(POSTING)]
            token = every[0]
            bucket = (token % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            used, starts = np.unique(bucket[order], return_index=True)
            cuts = [order[s:e] for s, e in zip(starts, np.append(starts[1:], len(order)))]
            yield pa.record_batch(
                [pa.array(used)] + [base.binary_column([x[c].tobytes() for c in cuts]) for x in every],
                names=["bucket", *POSTING],
            )

    return spread


FREQUENT_ROWS = "token long, rank int, cls long, size int, shared int, weight float, length int, salts int"


def _frequent_postings(percent: int, least: int, salt_rows: int):
    """The prefix tokens that many documents hold, a row each; ``salts`` says over how many parts a token's rows are dealt."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _prefixes(batch, percent, least, 256)
            if not rows:
                continue
            token, rank, cls, size, shared, weight, length, rarity = (np.concatenate(x) for x in zip(*rows))
            salts = np.ceil(2.0 ** ((rarity.astype(np.float64) + 1) / 4) / salt_rows).astype(np.int32)
            columns = [token.view(np.int64), rank, cls, size, shared, weight, length.astype(np.int32), salts]
            yield pa.record_batch([pa.array(c) for c in columns], names=[c.split()[0] for c in FREQUENT_ROWS.split(", ")])

    return spread


def frequent_postings(sets: DataFrame, percent: int, least: int, salt_rows: int) -> DataFrame:
    """FREQUENT_ROWS with a ``salt`` each, of the sets whose prefix holds a token of frequency class ``least`` or more."""
    end = prefix_end((F.octet_length("tokens") / 8).cast("int"), percent)
    highest = F.conv(F.hex(F.substring("rarity", end, F.lit(1))), 16, 10).cast("int")  # tokens are in order of frequency
    rows = sets.filter(highest >= least).mapInArrow(_frequent_postings(percent, least, salt_rows), FREQUENT_ROWS)
    return rows.withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("salts").cast("long")).cast("int"))


def every_salt(rows: DataFrame) -> DataFrame:
    """The rows once for each part of their token's list."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def frequent_stars(rows: DataFrame, percent: int) -> DataFrame:
    """``(a, b, n)``: how often ``b`` leads a list of a frequent token that holds ``a``, where the two may be similar."""
    order = F.struct("weight", F.bitwise_not("cls").alias("against"), F.col("size").alias("b_size"), F.col("shared").alias("b_shared"))
    led = rows.groupBy("token").agg(F.max(order).alias("m"), F.max("salts").alias("salts"))
    led = every_salt(led.select("token", "salts", F.bitwise_not("m.against").alias("b"), "m.b_size", "m.b_shared"))
    near = may_link(F.col("size"), F.col("b_size"), F.col("shared"), F.col("b_shared"), percent)
    met = rows.join(led, ["token", "salt"]).filter((F.col("cls") != F.col("b")) & near)
    return met.groupBy(F.col("cls").alias("a"), "b").agg(F.count("*").alias("n"))


PAIRS = "kind int, a long, b long, n int, token long, size int, shared int, rank int, length int"
STAR, SHORT_PAIR, LONG_LIST = 0, 1, 2


def may_link(size_x, size_y, shared_x, shared_y, percent: int):
    """Whether sets of these sizes, with so many tokens that other documents hold, may be similar; arrays or columns."""
    arrays = isinstance(size_x, np.ndarray)
    wide = (lambda v: v.astype(np.int64)) if arrays else (lambda v: v.cast("long"))
    least = np.minimum if arrays else F.least
    return (100 + percent) * least(wide(shared_x), wide(shared_y)) >= percent * (wide(size_x) + wide(size_y))


def overlap_asked(size_x, size_y, percent: int):
    """How many tokens sets of these sizes must share to be similar; arrays or columns."""
    if isinstance(size_x, np.ndarray):
        return -(-percent * (size_x.astype(np.int64) + size_y.astype(np.int64)) // (100 + percent))
    return F.ceil(percent * (size_x.cast("long") + size_y.cast("long")) / (100 + percent))


def in_prefix(rank, size, overlap, length):
    """Whether the token of this rank is among the first ``size - overlap + length``, of which a pair shares ``length``."""
    return rank <= size - overlap + length


def may_reach(rank_x, rank_y, size_x, size_y, shared_x, shared_y, overlap):
    """Whether a token of these ranks leaves room for the overlap: tokens shared before it are no more than either set
    has there, those of one document left out, and likewise behind it. Arrays or columns."""
    least = np.minimum if isinstance(rank_x, np.ndarray) else F.least
    before = least(rank_x - (size_x - shared_x), rank_y - (size_y - shared_y))
    return before + least(size_x - rank_x, size_y - rank_y) >= overlap


def _pairs(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, length: np.ndarray) -> pa.Table:
    columns = {"kind": np.full(len(a), kind, np.int32), "a": a, "b": b, "n": n.astype(np.int32)}
    columns |= {"token": pa.nulls(len(a), pa.int64())} | {c: pa.nulls(len(a), pa.int32()) for c in ("size", "shared", "rank")}
    return pa.table(columns | {"length": length.astype(np.int32)})


def _counted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of positions, with how often each occurs."""
    key, n = np.unique(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64), return_counts=True)
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64), n


def _lists(percent: int):
    def judge(table: pa.Table) -> pa.Table:
        posting = {name: np.frombuffer(b"".join(table.column(name).to_pylist()), kind) for name, kind in POSTING.items()}
        order = np.lexsort((posting["cls"], -posting["weight"], posting["token"]))
        token, rank, cls, size, shared, _, length = (posting[name][order] for name in POSTING)
        starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        counts = np.diff(np.append(starts, len(token)))
        nodes, node = np.unique(cls, return_inverse=True)
        # Lists are in order of weight, so their first member leads.
        follow = np.ones(len(token), bool)
        follow[starts] = False
        leader = np.repeat(starts, counts)[follow]
        follow = np.flatnonzero(follow)
        near = may_link(size[follow], size[leader], shared[follow], shared[leader], percent)
        a, b, n = _counted(node[follow[near]], node[leader[near]])
        out = [_pairs(STAR, nodes[a], nodes[b], n, np.ones(len(a)))]
        found = []
        for width in range(2, SHORT + 1):
            rows = starts[counts == width]
            if not len(rows):
                continue
            i, j = np.triu_indices(width, 1)
            for lo in range(0, len(rows), max(1, (1 << 20) // len(i))):
                at = rows[lo : lo + max(1, (1 << 20) // len(i)), None]
                x, y = (at + i).ravel(), (at + j).ravel()
                larger = (size[x] > size[y]) | ((size[x] == size[y]) & (cls[x] > cls[y]))
                x, y = np.where(larger, x, y), np.where(larger, y, x)
                overlap = overlap_asked(size[x], size[y], percent)
                keep = in_prefix(rank[x], size[x], overlap, length[x]) & in_prefix(rank[y], size[y], overlap, length[x]) & may_reach(rank[x], rank[y], size[x], size[y], shared[x], shared[y], overlap)
                found.append(_counted(node[x[keep]], node[y[keep]]))
        if found:
            a, b, n = (np.concatenate(x) for x in zip(*found))
            key, place = np.unique(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64), return_inverse=True)
            n = np.bincount(place, n, len(key))
            a, b = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
            asked = np.zeros(len(nodes), np.uint8)
            asked[node] = length
            out.append(_pairs(SHORT_PAIR, nodes[a], nodes[b], n, asked[a]))
        long = np.flatnonzero(np.repeat(counts > SHORT, counts))
        if len(long):
            one = np.ones(len(long), np.int32)
            columns = {"kind": one * LONG_LIST, "a": cls[long], "b": cls[long], "n": one, "token": token[long].astype(np.int64)}
            columns |= {"size": size[long], "shared": shared[long], "rank": rank[long], "length": length[long].astype(np.int32)}
            out.append(pa.table(columns))
        return pa.concat_tables(out)

    return judge


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate((x, y)))
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= percent * (len(both) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar enough, by exact intersection."""
    x = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))
    near = pairs.join(x, "a").join(y, "b").filter(
        (100 * F.octet_length("x") >= percent * F.octet_length("y")) & (100 * F.octet_length("y") >= percent * F.octet_length("x"))
    )
    return near.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long")


def apart_rows(member: DataFrame, percent: int) -> DataFrame:
    """One row ``(a, b, length)`` per token and pair of a long list that the first links left apart, ``a`` the larger."""
    columns = ("cls", "size", "shared", "rank", "length", "home")
    o = every_salt(member.filter("home <> main").select("token", "salts", *[F.col(c).alias(f"o_{c}") for c in columns]))
    p = member.select("token", "salt", "main", *[F.col(c).alias(f"p_{c}") for c in columns])
    larger = F.struct("o_size", "o_cls") > F.struct("p_size", "p_cls")
    asked = F.when(larger, F.col("o_length")).otherwise(F.col("p_length"))
    overlap = overlap_asked(F.col("o_size"), F.col("p_size"), percent)
    prefixes = [in_prefix(F.col(f"{s}_rank"), F.col(f"{s}_size"), overlap, asked) for s in "op"]
    room = may_reach(*[F.col(f"{s}_{c}") for c in ("rank", "size", "shared") for s in "op"], overlap)
    once = (F.col("p_home") == F.col("main")) | (F.col("o_cls") < F.col("p_cls"))
    return (
        o.join(p, (o.token == p.token) & (o.salt == p.salt) & (F.col("o_home") != F.col("p_home")) & once)
        .filter(prefixes[0] & prefixes[1] & room)
        .select(
            F.when(larger, F.col("o_cls")).otherwise(F.col("p_cls")).alias("a"),
            F.when(larger, F.col("p_cls")).otherwise(F.col("o_cls")).alias("b"),
            asked.alias("length"),
        )
    )


def class_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Components ``(node, comp)`` of classes ``(cls, tokens, rarity)``; classes without a link are left out."""
    total = sets.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    buckets = max(1, int(total / 8 * (100 - percent) / 100 / POSTINGS_PER_BUCKET) + 1)
    often = frequency_step(FREQUENT)
    blobs = sets.select("cls", "tokens", "rarity").mapInArrow(
        _postings(percent, buckets, often), "bucket long, " + ", ".join(f"{c} binary" for c in POSTING)
    )
    lists = base.stored(blobs.groupBy("bucket").applyInArrow(base.trimmed(_lists(percent)), PAIRS), "lists")
    frequent = base.stored(frequent_postings(sets.select("cls", "tokens", "rarity"), percent, often, SALT_ROWS), "frequent")
    star = lists.filter(F.col("kind") == STAR).select("a", "b", "n").unionByName(frequent_stars(frequent, percent))
    star = star.groupBy("a", "b").agg(F.sum("n").alias("n"))
    best = star.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b"))
    first = base.stored(verified(best, sets, percent), "star_links")
    comp = components(first)
    # What the first links leave apart.
    def of(rows: DataFrame, col: str, name: str) -> DataFrame:
        known = comp.select(F.col("node").alias(col), F.col("comp").alias("_c"))
        return rows.join(known, col, "left").withColumn(name, F.coalesce("_c", col)).drop("_c")

    short = lists.filter(F.col("kind") == SHORT_PAIR).groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("length").alias("length"))
    long_lists = lists.filter(F.col("kind") == LONG_LIST).select(
        "token", F.col("a").alias("cls"), "size", "shared", "rank", "length", F.lit(1).alias("salts"), F.lit(0).alias("salt")
    )
    member = base.stored(of(long_lists.unionByName(frequent.drop("weight")), "cls", "home"), "long_lists")
    spread = member.groupBy("token", "home").agg(F.count("*").alias("n"), F.max("salts").alias("salts")).groupBy("token")
    mixed = spread.agg(F.count("*").alias("homes"), F.max_by("home", F.struct("n", "home")).alias("main"), F.max("salts").alias("salts"))
    member = member.join(every_salt(mixed.filter("homes > 1").drop("homes")), ["token", "salt"])
    long = apart_rows(member, percent).groupBy("a", "b").agg(F.count("*").alias("n"), F.max("length").alias("length"))
    counted = short.select("a", "b", "n", "length").unionByName(long.select("a", "b", "n", "length"))
    enough = counted.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("length").alias("length")).filter("n >= length")
    apart = of(of(enough, "a", "ca"), "b", "cb").filter("ca <> cb").select("a", "b")
    second = base.stored(verified(apart, sets, percent), "cross_links")
    if second.isEmpty():
        return comp
    lifted = of(of(second, "a", "ca"), "b", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    higher = components(lifted)
    lone = higher.select("node", F.col("node").alias("comp")).join(comp.select("node"), "node", "left_anti").select("node", "comp")
    lift = higher.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    return comp.unionByName(lone).join(lift, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))


def classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, h, n_shingles, cls, …)``, ``h`` a hash of the text and ``cls`` the class of its set, null where it can have no
    link; and the components ``(node, comp)`` of classes."""
    base.prepare(docs.sparkSession)
    rows, _, total = blocks.in_blocks(docs, id_col, text_col)
    bits = blocks.bucket_bits(total / 6)
    dealt = rows.withColumn("h", F.xxhash64("text")).groupBy("blk")
    sent = dealt.applyInArrow(base.trimmed(_send_keys(shingle, bits)), blocks.BLOB)
    said = sent.groupBy("bucket").applyInArrow(base.trimmed(_answer_keys(bits)), blocks.BLOB)
    found = base.stored(dealt.cogroup(said.groupBy("blk")).applyInArrow(base.trimmed(_ordered_sets(shingle, percent, bits)), SETS), "sets")
    return found, class_links(found.filter(F.col("tokens").isNotNull()).select("cls", "tokens", "rarity"), percent)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row: documents whose shingle sets have a Jaccard similarity of
    ``percent`` or more are linked; the component is named by its smallest document id. Texts that share an id are one document."""
    found, comp = classes(docs, id_col, text_col, shingle, percent)
    linked = found.filter(F.col("cls").isNotNull()).select("doc_id", "n_shingles", "cls")
    # Classes with a document in common belong together, too.
    several = linked.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
    twice = several.agg(F.min("cls").alias("a"), F.max("cls").alias("z"), F.collect_set("cls").alias("all")).filter("a <> z")
    of = lambda col, name: comp.select(F.col("node").alias(col), F.col("comp").alias(name))
    home = base.look_up(linked, of("cls", "comp"), "cls").withColumn("home", F.coalesce("comp", "cls")).drop("comp")
    if not twice.isEmpty():
        pairs = twice.select("a", F.explode("all").alias("b")).filter("a <> b")
        lifted = pairs.join(of("a", "ca"), "a", "left").join(of("b", "cb"), "b", "left")
        higher = components(lifted.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
        to = higher.select(F.col("node").alias("home"), F.col("comp").alias("to"))
        home = home.join(to, "home", "left").withColumn("home", F.coalesce("to", "home")).drop("to")
    home = base.stored(home.select("doc_id", "n_shingles", "home"), "homes")
    least = home.filter(F.col("doc_id").isNotNull()).groupBy("home").agg(F.min("doc_id").alias("component_id"))
    named = base.look_up(home, least, "home").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )
    alone = found.filter(F.col("cls").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return alone.unionByName(named)


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose text belongs to the smallest id of its component.

    Texts are judged, not ids: of rows that share an id, those with texts that are not similar all stay. Of a component one text
    stays, the least by hash if its smallest id has several; of rows with equal ids and texts one stays. Rows with a null id stay.
    """
    found, comp = classes(docs, id_col, text_col, shingle, percent)
    known = found.filter("cls IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "h", "cls").distinct()
    known = base.stored(known, "classes")
    home = base.look_up(known, comp.select(F.col("node").alias("cls"), "comp"), "cls").select("doc_id", "h", F.coalesce("comp", "cls").alias("home"))
    home = base.stored(home, "homes")
    first = home.groupBy("home").agg(F.min(F.struct("doc_id", "h")).alias("first"))
    gone = base.look_up(home, first, "home").filter(F.struct("doc_id", "h") != F.col("first")).select("doc_id", "h")
    rows = base.packed(docs, doc_id=id_col, h=text_col).select(
        "row", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("h").cast("string")).alias("h")
    )
    once = rows.filter("doc_id IS NOT NULL").groupBy("doc_id", "h").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    left = once.join(base.stored(gone, "gone"), ["doc_id", "h"], "left_anti").select("row")
    return left.unionByName(rows.filter("doc_id IS NULL").select("row")).select("row.*")
