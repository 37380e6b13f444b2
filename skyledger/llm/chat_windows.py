"""Chat formatting in budgeted windows.

Every turn's tokens are counted once; a prefix sum over the conversation, from sums of blocks of turns, gives each turn the
range of positions it takes. Ranges choose turn-aligned spans: turns that lie wholly in the same stretch of a conversation
make a window, a turn across a border is a window of its own. A stretch is what the budget leaves beside the history and the
system turn, and no window depends on another one's cut.

A window begins with the conversation's system turn, if it has one, then repeats the turns of the last ``history``
positions before it, whole turns only, then holds its new turns. All of it stays within the budget: beside a long new turn less
history is repeated. Only two things can exceed it: a single new turn that is too long beside the system turn, which then
stands without history, and a system turn longer than half of what the history leaves, as stretches keep at least the other half.
Only texts of new assistant turns are under the loss mask; all that is repeated is masked, so each assistant text is learned
once.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is doubled and ``<|`` becomes
``<\\|``, so no text can hold a control string; a line break in a role becomes ``\\n``. ``parse`` undoes this exactly.

Turns are in order of turn number (null first), role and text; equal rows follow one another. Null texts and roles are
empty, a null conversation id is a conversation. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import base

# The template's control strings and its roles.
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, ASSISTANT = "system", "assistant"

BUDGET, HISTORY = 1024, 256
#: Tokens of a turn besides its text; turns per block of the prefix sum.
TURN_TOKENS, TURN_BLOCK = 6, 256
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def _encoding(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, ranks: str = RANKS) -> Column:
    """Tokens of a text by a byte-pair vocabulary; ``ranks`` is its file on every machine."""

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        encoding = _encoding(ranks)
        return pa.array([len(encoding.encode_ordinary(t)) for t in texts.to_pylist()], pa.int64())

    return counted(text)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(turns: list[tuple[int, str, str]]) -> tuple[str, list[tuple[int, int]], int]:
    """The formatted window, the ranges of its code points under the loss mask, and how many turns are repeated;
    turns are ``(new, role, text)``."""
    out, spans, at, repeated = [], [], 0, 0
    for new, role, text in turns:
        head = START + escape(role).replace("\n", "\\n") + "\n"
        body = escape(text)
        if new and role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        repeated += not new
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans, repeated


TURN = re.compile(re.escape(START) + "([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window; refuses anything between turns."""
    turns, at = [], 0
    for m in TURN.finditer(text):
        if m.start() != at:
            raise ValueError("text outside turns")
        at = m.end()
        role = re.sub(r"\\(.)", lambda c: "\n" if c[1] == "n" else c[1], m[1])
        turns.append((role, unescape(m[2])))
    if at != len(text):
        raise ValueError("text outside turns")
    return turns


WINDOWS = "text: string, loss: array<struct<start: long, end: long>>, repeated: long"
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _rendered(turns: pa.Array) -> pa.Array:
    found = [render([(t["new"], t["role"], t["text"]) for t in row]) for row in turns.to_pylist()]
    return pa.StructArray.from_arrays(
        [
            pa.array([f[0] for f in found], pa.string()),
            pa.array([[{"start": s, "end": e} for s, e in f[1]] for f in found], _LOSS),
            pa.array([f[2] for f in found], pa.int64()),
        ],
        ["text", "loss", "repeated"],
    )


def positions(turns: DataFrame, tokens: Column) -> DataFrame:
    """The turns with ``start`` and ``end``: prefix sums of their tokens within the conversation, by blocks of turns."""
    counted = base.stored(turns.withColumn("tokens", tokens + TURN_TOKENS).withColumn("part", F.floor(F.col("turn") / TURN_BLOCK)), "turns")
    sums = counted.groupBy("conv", "part").agg(F.sum("tokens").alias("n"))
    earlier = Window.partitionBy("conv").orderBy(F.asc_nulls_first("part")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("conv", F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("conv", "part").orderBy(F.asc_nulls_first("turn"), "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumn("run", F.sum("tokens").over(inside))
    joined = summed.join(offsets.withColumnRenamed("conv", "c"), (F.col("conv") == F.col("c")) & F.col("part").eqNullSafe(F.col("p")))
    return joined.withColumn("end", F.col("offset") + F.col("run")).withColumn("start", F.col("end") - F.col("tokens")).drop("c", "p", "part", "run", "offset")


def windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=token_count, conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """``(conv_id, window, first, text, loss, repeated, n_new)``: formatted windows in the order of ``window``."""
    base.prepare(conversations.sparkSession)
    no_id = -(2**63)
    string = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    turns = conversations.select(
        F.coalesce(F.col(f"`{conv}`").cast("long"), F.lit(no_id)).alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        string(role).alias("role"),
        string(text).alias("text"),
    )
    placed = base.stored(positions(turns, tokens(F.col("text"))), "positions")
    room = max(1, budget - history)
    is_system = (F.col("start") == 0) & (F.col("role") == SYSTEM)
    systems = placed.filter(is_system).select("conv", "role", "text", "tokens").withColumnRenamed("conv", "_conv")
    costs = systems.select("_conv", F.col("tokens").alias("system"))
    named = placed.join(costs, F.col("conv") == F.col("_conv"), "left").drop("_conv").withColumn("system", F.coalesce("system", F.lit(0)))
    stretch = F.greatest(F.lit(room) - F.col("system"), F.lit(max(1, room // 2)))
    low, high = F.floor(F.col("start") / stretch), F.floor((F.col("end") - 1) / stretch)
    named = named.withColumn("window", 2 * low + (high > low).cast("long"))
    begins = named.groupBy("conv", "window").agg(F.min("start").alias("begin"), F.sum("tokens").alias("new"), F.first("system").alias("system"))
    # The window of the system turn holds it among its new turns.
    begins = begins.withColumn("shown", (F.col("begin") > 0) & (F.col("system") > 0))
    left = F.lit(budget) - F.col("new") - F.when(F.col("shown"), F.col("system")).otherwise(0)
    begins = begins.withColumn("behind", F.greatest(F.least(left, F.lit(history)), F.lit(0)))
    new = named.select("conv", "window", F.lit(2).alias("kind"), "start", "role", "text")
    # A turn is repeated where a window begins within the history behind it; both fall into neighbouring cells.
    cell = max(1, history)
    here = F.floor(F.col("start") / cell)
    spread = named.filter(~is_system).select(
        "conv", "start", "end", "role", "text", F.col("window").alias("own"), F.explode(F.array(here, here + 1)).alias("cell")
    )
    ahead = begins.select("conv", "window", "begin", "behind", F.floor(F.col("begin") / cell).alias("cell"))
    repeated = spread.join(ahead, ["conv", "cell"]).filter("window > own AND begin >= end AND begin - start <= behind")
    repeated = repeated.select("conv", "window", F.lit(1).alias("kind"), "start", "role", "text")
    again = begins.filter("shown").join(systems.drop("tokens"), F.col("conv") == F.col("_conv")).select(
        "conv", "window", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("start"), "role", "text"
    )
    every = new.unionByName(repeated).unionByName(again)
    rows = every.groupBy("conv", "window").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "role", "text"))).alias("turns"))
    as_turn = lambda t: F.struct((t["kind"] == 2).cast("int").alias("new"), t["role"].alias("role"), t["text"].alias("text"))
    shaped = rows.withColumn("f", F.arrow_udf(_rendered, WINDOWS)(F.transform("turns", as_turn)))
    return shaped.select(
        F.when(F.col("conv") != no_id, F.col("conv")).alias("conv_id"),
        "window",
        F.col("f.text").alias("text"),
        F.col("f.loss").alias("loss"),
        F.col("f.repeated").alias("repeated"),
        (F.size("turns") - F.col("f.repeated")).alias("n_new"),
    )


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows arrive conversation by conversation, in order; only digests are kept between them."""
    done: list[tuple] = []
    now = None

    def close() -> None:
        if now is not None:
            done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        out = pa.record_batch([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=names)
        done.clear()
        return out

    for batch in batches:
        for row in batch.to_pylist():
            if now is None or now[0] != row["conv_id"]:
                close()
                now = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(row["text"])[row["repeated"] :]:
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
            for span in row["loss"]:
                under = unescape(row["text"][span["start"] : span["end"]])
                now[3] += len(under)
                now[4].update(under.encode())
            now[5] += len(row["text"])
        if len(done) > 1000:
            yield flush()
    close()
    yield flush()


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted windows alone: turns, text under the loss mask, and lengths."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.select("conv_id", "text", "loss", "repeated").mapInArrow(_digested, DIGESTS)
