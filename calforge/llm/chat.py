r"""Chat formatting by token-level assembly.

A turn reads ``<|im_start|>role\n text<|im_end|>\n`` (no blank before the text). Only the role and
the text go through the tokenizer, each by itself; the two control strings are reserved ids
spliced between them, which no text can yield. Nothing is ever decided by searching the formatted
text, so a turn that quotes the template cannot end itself or begin another one.

A control string inside a text is written with a backslash behind its '<' (one more if it has
some already); taking one away gives the text back. A role's line breaks and backslashes are
escaped alike, so the first line break of a turn ends its role.

The loss mask comes from segment lengths: +1 at the first id of each trained text, -1 behind its
last, and the prefix sum of those marks over the batch. Reserved ids are never under the mask.

Turns are encoded where they are read, then dealt out by conversation, sorted, and joined in one
pass. A conversation of more than ``part_tokens`` ids comes out as several parts in order, so no task
holds a conversation whole; a turn is never cut. ``read_back`` goes through parts as a stream.

Rows: turns go by turn (a null one first), ties by role and the text's digest; a null text or role is empty; repeated
rows are turns of their own; null ids of conversations are one conversation; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calforge.llm.bpe import _bytes_by_id, _encoding
from calforge.llm.common import steps

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = ("assistant",)
#: Ids in one part of a conversation (a longer turn is a part of its own).
PART_TOKENS = 1 << 18

_CONTROL = r"<(\\*)\|(im_start|im_end)\|>"
_ESCAPED = re.compile(r"<\\(\\*\|(?:im_start|im_end)\|>)")


def escaped(text):
    """A text column with its control strings escaped."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, r"<$1\\|$2|>")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def escaped_role(role):
    return F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


def reserved_ids(ranks: bytes) -> tuple[int, int]:
    """The ids of both control strings: the first two behind the last rank."""
    top = len(_bytes_by_id(ranks))
    return top, top + 1


def _assembler(sent, pattern: str):
    """Ids and mask of every turn of a batch in one array each."""
    def run(batches):
        enc = _encoding(sent.value, pattern)
        start, end = reserved_ids(sent.value)
        line_end = enc.encode_ordinary("\n")
        for batch in steps(batches, "text"):
            trained = np.array([bool(x) for x in batch.column("trained").to_pylist()], np.int64)
            segments, sizes = [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                head, body = enc.encode_ordinary(role + "\n"), enc.encode_ordinary(text)
                segments += [[start], head, body, [end], line_end]
                sizes.append((1 + len(head), len(body), 1 + len(line_end)))
            size = np.array(sizes, np.int64).reshape(-1, 3)
            ids = np.concatenate([np.array(s, "<u4") for s in segments]) if segments else np.zeros(0, "<u4")
            ends = np.cumsum(size.sum(1))
            body_at = ends - size[:, 2] - size[:, 1]
            marks = np.zeros(len(ids) + 1, np.int64)
            np.add.at(marks, body_at, trained)
            np.add.at(marks, body_at + size[:, 1], -trained)
            loss = np.cumsum(marks[:-1]).astype(np.uint8)
            bounds = np.concatenate([[0], ends])
            ids_col = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds * 4), pa.py_buffer(ids)])
            loss_col = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(loss)])
            names = ["conv_id", "turn", "role", "key"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), ids_col.cast(pa.binary()), loss_col.cast(pa.binary())],
                                             [*names, "ids", "loss"])
    return run


def _joiner(part_tokens: int):
    """Sorted turns -> parts of conversations, as they pass."""
    names = ["conv_id", "part", "ids", "loss"]

    def out(rows, kind):
        types = (kind, pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def run(batches):
        conv, held, n_held, part, kind = None, [], 0, 0, None
        for batch in batches:
            for piece in steps([batch], "ids"):
                begun, kind, rows = kind is not None, piece.schema.field("conv_id").type, []
                for c, ids, loss in zip(*(piece.column(n).to_pylist() for n in ("conv_id", "ids", "loss")), strict=True):
                    new = not begun or c != conv
                    if held and (new or n_held + len(loss) > part_tokens):
                        rows.append((conv, part, b"".join(x for x, _ in held), b"".join(x for _, x in held)))
                        held, n_held, part = [], 0, part + 1
                    if new:
                        conv, part, begun = c, 0, True
                    held.append((ids, loss))
                    n_held += len(loss)
                if rows:
                    yield out(rows, kind)
        if held:
            yield out([(conv, part, b"".join(x for x, _ in held), b"".join(x for _, x in held))], kind)

    return run


def formatted(conversations: DataFrame, ranks: bytes, pattern: str, trained: tuple[str, ...] = TRAINED,
              part_tokens: int = PART_TOKENS) -> DataFrame:
    """``conv_id, turn, role, text`` -> ``conv_id, part, ids, loss``: ids as little-endian unsigned
    32-bit integers, loss one byte (0 or 1) an id. The parts of a conversation follow each other
    in one partition. ``ranks`` is a rank file (bounded)."""
    sent = conversations.sparkSession.sparkContext.broadcast(ranks)
    types = {f.name: f.dataType.simpleString() for f in conversations.schema}
    rows = conversations.select("conv_id", "turn", escaped_role(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"),
                                F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"), F.col("role").isin(*trained).alias("trained"))
    turns = rows.mapInArrow(_assembler(sent, pattern),
                            f"conv_id {types['conv_id']}, turn {types['turn']}, role string, key string, ids binary, loss binary")
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "key").select("conv_id", "ids", "loss")
    return dealt.mapInArrow(_joiner(part_tokens), f"conv_id {types['conv_id']}, part int, ids binary, loss binary")


def in_order(parts: DataFrame) -> DataFrame:
    """Parts of a stored table, dealt out as ``formatted`` returned them."""
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")


def _reader(sent):
    """Parts in order -> one row per conversation, all of it read from ids and mask."""
    def run(batches):
        table = _bytes_by_id(sent.value)
        start, end = reserved_ids(sent.value)
        shown = [*table, START.encode(), END.encode()]

        class Read:
            def __init__(self):
                self.turns, self.trained = hashlib.sha256(), hashlib.sha256()
                self.n_turns = self.loss_chars = self.chars = 0

            def add(self, ids, loss):
                at = np.flatnonzero(ids == start)
                for a, z in zip(at, [*at[1:], len(ids)], strict=True):
                    inner = ids[a + 1:z]
                    stop = int(np.flatnonzero(inner == end)[-1])
                    whole = b"".join([table[i] for i in inner[:stop].tolist()]).decode()
                    after = b"".join([table[i] for i in inner[stop + 1:].tolist()]).decode()
                    role, text = whole.split("\n", 1)
                    self.turns.update(f"{unescaped_role(role)}\n{unescaped(text)}\n".encode())
                    under = inner[loss[a + 1:z].astype(bool)]
                    learned = unescaped(b"".join([shown[i] for i in under.tolist()]).decode())
                    self.trained.update(learned.encode())
                    self.loss_chars += len(learned)
                    self.chars += len(START) + len(whole) + len(END) + len(after)
                    self.n_turns += 1

            def row(self):
                return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.trained.hexdigest(), self.chars

        conv, now = None, None
        kind, names = pa.int64(), ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def out(rows):
            cols = list(zip(*rows, strict=True))
            types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        for batch in batches:
            for piece in steps([batch], "ids"):
                kind, done = piece.schema.field("conv_id").type, []
                for c, ids, loss in zip(*(piece.column(n).to_pylist() for n in ("conv_id", "ids", "loss")), strict=True):
                    if now is None or c != conv:
                        if now is not None:
                            done.append((conv, *now.row()))
                        conv, now = c, Read()
                    now.add(np.frombuffer(ids, "<u4"), np.frombuffer(loss, np.uint8))
                if done:
                    yield out(done)
        if now is not None:
            yield out([(conv, *now.row())])
    return run


def read_back(parts: DataFrame, ranks: bytes) -> DataFrame:
    """Parts in order (of ``formatted`` or ``in_order``) -> per conversation: ``n_turns``, digest of
    its turns, characters and digest of the text under the mask, characters of the whole."""
    sent = parts.sparkSession.sparkContext.broadcast(ranks)
    kind = parts.schema["conv_id"].dataType.simpleString()
    return parts.select("conv_id", "ids", "loss").mapInArrow(
        _reader(sent), f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
