"""Chat formatting at token level.

Each turn is ``<|im_start|>{role}\\n{text}<|im_end|>\\n``. The pieces of text are
encoded separately with the tokenizers library and the two control tokens are
spliced in as reserved ids after the vocabulary, so no text can produce them.
Inside texts and roles ``<|`` is written ``<\\|`` (and ``<\\|`` as ``<\\\\|``, and so
on), which is reversible and leaves no control string in the content; a line
break in a role is written ``\\n``.

The loss mask covers the text of assistant turns and nothing else: segment
lengths are summed to boundaries, and the mask is the running sum of +1 where a
trained segment begins and -1 where it ends.

Turns are range partitioned by conversation and turn, so that a conversation of
any size is dealt over many tasks. A stored turn is one row (conv_id, part, seq,
start, ids, mask): ``seq`` and ``start`` count turns and ids within the
conversation's rows of that part. A conversation that reaches over several parts
has one row of offsets for each; there are at most two such rows a part, so they
may be broadcast. No conversation is ever collected.

Defined results: a null text or role is empty; a null turn sorts first; turns
that tie sort by role, then text, and all count; a null conv_id is one
conversation of its own; an empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch
from .common import pick
from .tokens import encoder

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")

TURN = "conv_id long, part int, seq long, start long, ids binary, mask binary"
#: Code points of role and text that help to place the range bounds; rows sort by whole values.
BOUND_CHARS = 64


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def splice(head: list[int], body: list[int], tail: list[int], trained: bool, reserved: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of one turn from its separately encoded segments."""
    segments = [[reserved[0]], head, body, [reserved[1]], tail]
    bounds = np.cumsum([0] + [len(s) for s in segments])
    delta = np.zeros(bounds[-1] + 1, np.int8)
    if trained:
        delta[bounds[2]] += 1
        delta[bounds[3]] -= 1
    return np.concatenate([np.array(s, np.uint32) for s in segments]), np.cumsum(delta[:-1]).astype(np.uint8)


def format_turns(conversations: DataFrame, *, tokenizer: str) -> DataFrame:
    """(conv_id, part, seq, start, ids, mask) of every turn; ids are little-endian 32-bit numbers."""
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    rows = rows.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        size = own.tokenizer.get_vocab_size()
        read = lambda blob: array(own.kind, blob).tolist()
        tail = read(own.encode(["\n"])[0])
        now, seq, start = object(), 0, 0
        for frame in frames:
            convs, roles, texts = (frame.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            heads = own.encode([escape_role(r) + "\n" for r in roles])
            bodies = own.encode([escape(t) for t in texts])
            out: list[tuple] = []
            for conv, role, head, body in zip(convs, roles, heads, bodies):
                if conv != now:
                    now, seq, start = conv, 0, 0
                ids, mask = splice(read(head), read(body), tail, role == TRAINED, (size, size + 1))
                seq += 1
                out.append((seq, start, ids.astype("<u4").tobytes(), mask.tobytes()))
                start += len(ids)
            columns = [pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([frame.column("conv_id"), frame.column("part"), *columns], ["conv_id", "part", "seq", "start", "ids", "mask"])

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    ranges = [F.left(F.col(c), F.lit(BOUND_CHARS)) for c in ("role", "text")]
    dealt = rows.repartitionByRange(*order, *ranges).sortWithinPartitions(*order, "role", "text")
    return dealt.select("conv_id", F.spark_partition_id().alias("part"), "role", "text").mapInArrow(run, TURN)


def write_turns(spark: SparkSession, conversations: DataFrame, *, tokenizer: str, path: str | None = None) -> str:
    path = path or scratch(spark, "llm-chat")
    format_turns(conversations, tokenizer=tokenizer).write.parquet(path)
    return path


def stored_turns(spark: SparkSession, path: str) -> DataFrame:
    """(conv_id, seq, start, ids, mask) with ``seq`` and ``start`` counted over whole conversations."""
    rows = spark.read.schema(TURN).parquet(path)
    sums = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("turns"), F.sum(F.octet_length("mask").cast("long")).alias("tokens"))
    by_conv = Window.partitionBy("conv_id")
    before = by_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("parts", F.count(F.lit(1)).over(by_conv)).filter("parts > 1")
    offsets = offsets.select(F.col("conv_id").alias("conv"), F.col("part").alias("at"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("turns", "tokens")])
    found = rows.join(F.broadcast(offsets), F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("part") == F.col("at")), "left")
    return found.select("conv_id", *[(F.col(own) + F.coalesce(F.col(more), F.lit(0))).alias(own) for own, more in (("seq", "turns"), ("start", "tokens"))], "ids", "mask")


def read_turns(spark: SparkSession, path: str, *, tokenizer: str) -> DataFrame:
    """(conv_id, seq, role, text, loss, formatted) decoded from ids and mask alone; ``loss`` is the
    unescaped text under the mask (null where the mask is empty), ``formatted`` the whole turn."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = encoder(tokenizer).tokenizer
        size = tk.get_vocab_size()

        def decode(ids: np.ndarray) -> str:
            return tk.decode(ids.tolist(), skip_special_tokens=False)

        for frame in frames:
            out: list[tuple] = []
            for ids, mask in zip(frame.column("ids").to_pylist(), frame.column("mask").to_pylist()):
                ids, mask = np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.uint8).astype(bool)
                begin, end = np.flatnonzero(ids == size)[0], np.flatnonzero(ids == size + 1)[0]
                role, _, text = decode(ids[begin + 1 : end]).partition("\n")
                loss = unescape(decode(ids[mask])) if mask.any() else None
                formatted = decode(ids[:begin]) + START + role + "\n" + text + END + decode(ids[end + 1 :])
                out.append((unescape_role(role), unescape(text), loss, formatted))
            columns = [pa.array([o[i] for o in out], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([frame.column("conv_id"), frame.column("seq"), *columns], ["conv_id", "seq", "role", "text", "loss", "formatted"])

    rows = stored_turns(spark, path).select("conv_id", "seq", "ids", "mask")
    return rows.mapInArrow(run, "conv_id long, seq long, role string, text string, loss string, formatted string")


SUMMARY = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, role, text, loss, loss_is_text, n_formatted) -> None:
        loss = text if loss_is_text else loss
        self.n_turns += 1
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update((loss or "").encode())
        self.loss_chars += len(loss or "")
        self.formatted_chars += n_formatted

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)


def summarise(turns: DataFrame) -> DataFrame:
    """One row of digests a conversation, streamed over turns in order.

    A digest over a conversation needs its turns in one stream; each text is shuffled once
    (a loss text equal to it is not sent again, nor is the formatted text, only its length).
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in SUMMARY.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(6)], names)
        now = None
        for frame in frames:
            done = []
            for conv_id, *values in zip(*[frame.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss", "loss_is_text", "n_formatted")]):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv_id)
                now.add(*values)
            yield batch(done)
        if now is not None:
            yield batch([now.row()])

    same = F.coalesce(F.col("loss") == F.col("text"), F.lit(False))
    sent = turns.select("conv_id", "seq", "role", "text", F.when(~same, F.col("loss")).alias("loss"), same.alias("loss_is_text"), F.length("formatted").cast("long").alias("n_formatted"))
    return sent.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(run, SUMMARY)
