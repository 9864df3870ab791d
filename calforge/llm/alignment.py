"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A is a byte-level BPE file (``tokenizers``), B a piece model (``sentencepiece``). Both see the
text behind one blank: A gets it written out, B adds its own. A token's bytes are its entry
decoded from the byte alphabet (A), or its piece with U+2581 as a blank and <0xHH> as that byte
(B). Where the tokens of each side joined give exactly blank + text, both cut the same bytes.

Texts are encoded in chunks, each distinct one once: neither side has a token across the place
before a blank that follows another character and is followed by none of white space (A's pattern
begins a word there; none of B's pieces has a blank behind another character, which is checked, and
a model where that does not hold gets whole texts).

Token starts rise through a batch: at each start of either side the tokens of both sides that cover
it are looked up, which gives every pair of tokens that share a byte once (``overlaps``). Pairs that
end together are ``links``; the places where they end cut the text into groups, the smallest
stretches that both sides tile.

``link_counts`` counts the linked id pairs of the whole corpus (added up inside each document
first). ``scored`` gives each document the counts of its links. Counts go out to the tasks as
sorted arrays, at most MOST_SENT pairs of the highest counts; how many pairs there are is
checked first, and the links of pairs beyond them go through a join instead.

Rows: a null or empty text, or one that either side does not give back byte by byte (a text with
U+2581 in it), has no tokens: zeros and no groups. Special strings in a text are plain text.
Repeated rows are counted and returned as often as they come; null ids are kept; extra columns
are ignored; an empty table gives an empty result. A text without a place to cut is encoded whole,
so a task holds one whole text at least.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from calforge.llm.common import steps, stored

#: Bytes of text that are encoded and aligned at once (a longer text is a step of its own).
ALIGN_BYTES = 1 << 20
#: Pairs whose counts are sent to every task: 16 bytes each.
MOST_SENT = 1 << 20
_ID_BITS = 32
#: Chunks, and characters of them, whose encoding a task keeps for later texts.
KEPT_CHUNKS, KEPT_CHARS = 1 << 18, 1 << 22
#: Chunks that are encoded in one call, a blank between each two.
ONE_CALL = 256
#: The places where no token of either side crosses: a blank between two words.
_CUT = re.compile(r" (?<=[^ ] )(?=\S)")


def model_of(path: str) -> bytes:
    """A tokenizer file as it is."""
    with open(path, "rb") as f:
        return f.read()


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """One tokenizer: ids of texts, the bytes of every id, and whether texts may be cut at ``_CUT``."""

    def __init__(self, encode, table: list[bytes], cuts: bool):
        self.encode = encode
        self.table = table
        self.cuts = cuts
        self.sizes = np.array([len(b) for b in table], np.int64)


@lru_cache(maxsize=2)
def _byte_level(model: bytes) -> Side:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"     # one task, one core
    tok = Tokenizer.from_str(model.decode())
    tok.encode_special_tokens = True
    alphabet = _byte_alphabet()

    def entry(i):
        token = tok.id_to_token(i) or ""
        return bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()

    def encode(texts):
        return [e.ids for e in tok.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    file = json.loads(model)
    words = file["pre_tokenizer"] or {}
    cuts = (file["normalizer"] is None and file["post_processor"] is None and words.get("type") == "ByteLevel"
            and words["use_regex"] and not words["add_prefix_space"] and all(t["special"] for t in file["added_tokens"]))
    return Side(encode, [entry(i) for i in range(tok.get_vocab_size(with_added_tokens=True))], cuts)


@lru_cache(maxsize=2)
def _pieces(model: bytes) -> Side:
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)

    def entry(i):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            return bytes([int(re.fullmatch("<0x([0-9A-F]{2})>", piece)[1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(texts):
        return sp.encode(texts, num_threads=1)

    # also false where the model takes blanks away: it must give back each of them, and add one
    cuts = (sp.decode(sp.encode("  a  b ")) == "  a  b " and sp.encode("  a", out_type=str)[0].startswith("▁")
            and not any(re.search("[^▁]▁", sp.id_to_piece(i)) for i in range(sp.get_piece_size())))
    return Side(encode, [entry(i) for i in range(sp.get_piece_size())], cuts)


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of the ranges ``first, first + 1, ...`` of ``n`` each, in order."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class _Chunks:
    """Both sides' tokens of every distinct chunk seen: a chunk's number, whether both sides give it
    back behind a blank, and for each side the place and number of its tokens."""

    def __init__(self, side_a: Side, side_b: Side):
        self.sides = side_a, side_b
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.good = np.zeros(0, bool)
        self.ids, self.n = ([np.zeros(0, np.int64)] * 2 for _ in range(2))

    def cut(self, texts: list[str]) -> list[list[str]]:
        return [_CUT.split(t) for t in texts] if all(s.cuts for s in self.sides) else [[t] for t in texts]

    def add(self, chunks: list[str]) -> None:
        """Encodes the chunks not seen yet. Those that may stand next to others (a cut is on both
        sides then) go many at a time; a call that does not give back its bytes is made again for each."""
        fresh = [c for c in dict.fromkeys(chunks) if c not in self.number]
        near, alone = [], []
        for c in fresh:
            (alone if not c or c[0].isspace() or c[-1] == " " else near).append(c)
        if not all(s.cuts for s in self.sides):
            near, alone = [], fresh
        alone = self._encode([near[i:i + ONE_CALL] for i in range(0, len(near), ONE_CALL)]) + [[c] for c in alone]
        bad = [c for call in self._encode(alone) for c in call]
        self._number(bad, False)
        self.n = [np.concatenate([n, np.zeros(len(bad), np.int64)]) for n in self.n]

    def _number(self, chunks: list[str], good: bool) -> None:
        self.number.update(zip(chunks, range(len(self.number), len(self.number) + len(chunks)), strict=True))
        self.chars += sum(map(len, chunks))
        self.good = np.concatenate([self.good, np.full(len(chunks), good)])

    def _encode(self, calls: list[list[str]]) -> list[list[str]]:
        """Keeps the tokens of the calls that both sides give back; the chunks of the others, one by one."""
        lines = [" ".join(c) for c in calls]
        ids = [side.encode(lines) if lines else [] for side in self.sides]
        good = [all(b"".join([side.table[t] for t in x]) == w for side, x in zip(self.sides, both, strict=True))
                for w, *both in zip([b" " + t.encode() for t in lines], *ids, strict=True)]
        kept = [c for call, ok in zip(calls, good, strict=True) if ok for c in call]
        ends = np.cumsum(np.array([len(c.encode()) + 1 for c in kept], np.int64))
        for i, side in enumerate(self.sides):
            flat = np.array([t for x, ok in zip(ids[i], good, strict=True) if ok for t in x], np.int64)
            upto = np.cumsum(side.sizes[flat])
            last = np.searchsorted(upto, ends)
            assert (upto[last] == ends).all()              # no token crosses a cut
            self.ids[i] = np.concatenate([self.ids[i], flat])
            self.n[i] = np.concatenate([self.n[i], np.diff(last, prepend=-1)])
        self._number(kept, True)
        return [[c] for call, ok in zip(calls, good, strict=True) if not ok for c in call]


class _Tokens:
    """The tokens of one side over a batch: document, id and byte range of each, where byte
    ranges count from the batch's first text on (so they rise through the whole batch)."""

    def __init__(self, side: Side, n: np.ndarray, ids: np.ndarray):
        self.n = n
        self.id = ids
        self.doc = np.repeat(np.arange(len(n)), n)
        self.end = np.cumsum(side.sizes[self.id])
        self.start = self.end - side.sizes[self.id]
        self.base = np.cumsum(self.n) - self.n           # position of each document's first token


def _both(chunks: _Chunks, texts: list[str]) -> tuple[np.ndarray, _Tokens, _Tokens]:
    """Tokens of both sides, and which texts have any: both sides must give back blank + text."""
    if len(chunks.number) > KEPT_CHUNKS or chunks.chars > KEPT_CHARS:
        chunks.forget()
    parts = chunks.cut(texts)
    flat = [c for p in parts for c in p]
    chunks.add(flat)
    number = chunks.number
    used = np.array([number[c] for c in flat], np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    whole = (np.bincount(doc[~chunks.good[used]], minlength=len(texts)) == 0) & np.array([t != "" for t in texts], bool)
    kept = whole[doc]
    used, doc = used[kept], doc[kept]
    sides = []
    for side, ids, n in zip(chunks.sides, chunks.ids, chunks.n, strict=True):
        many = n[used]
        sides.append(_Tokens(side, np.bincount(doc, many, len(texts)).astype(np.int64), ids[_ranges((np.cumsum(n) - n)[used], many)]))
    a, b = sides
    assert (a.end[-1:] == b.end[-1:]).all()
    return whole, a, b


def _overlaps(a: _Tokens, b: _Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of tokens that share a byte, in text order: those that cover each
    place where a token of either side starts."""
    at = np.sort(np.concatenate([a.start, b.start]), kind="stable")      # two sorted runs
    at = at[np.diff(at, prepend=-1) > 0]
    return np.searchsorted(a.start, at, "right") - 1, np.searchsorted(b.start, at, "right") - 1


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def _number_strings(n: int) -> np.ndarray:
    """Ids as decimal text with what follows them: a token, a group's last A, a group's last B. One
    row of bytes each, filled up with zeros."""
    rows = np.array([b"%d%s" % (i, after) for after in (b",", b"|", b";") for i in range(n)])
    return rows.view(np.uint8).reshape(len(rows), -1)


def _group_digests(a: _Tokens, b: _Tokens, ends_a: np.ndarray, ends_b: np.ndarray, strings: np.ndarray, width: int) -> list[str]:
    """sha256 of ``a1,a2|b1;a3|b2,b3`` of each document; '' without tokens. ``ends_*`` marks the
    tokens that end a group."""
    group = [np.cumsum(e) - e for e in (ends_a, ends_b)]             # groups before each token
    groups = int(ends_a.sum())
    size_a, size_b = (np.bincount(g, minlength=groups) for g in group)
    code = np.empty(len(a.id) + len(b.id), np.int64)
    code[np.arange(len(a.id)) + (np.cumsum(size_b) - size_b)[group[0]]] = a.id + width * ends_a
    code[np.arange(len(b.id)) + np.cumsum(size_a)[group[1]]] = b.id + 2 * width * ends_b
    upto = np.concatenate([[0], np.cumsum(np.count_nonzero(strings, axis=1)[code])])
    line = strings[code]
    line = line[line != 0]
    cuts = upto[np.concatenate([[0], np.cumsum(a.n + b.n)])].tolist()
    return [hashlib.sha256(line[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def _aligner(sent_a, sent_b):
    """One row per text: sizes, digest of its groups, and its distinct linked id pairs with how
    often the text holds each."""
    def run(batches):
        side_a, side_b = _byte_level(sent_a.value), _pieces(sent_b.value)
        width = max(len(side_a.table), len(side_b.table))
        strings, chunks = _number_strings(width), _Chunks(side_a, side_b)
        for batch in steps(batches, "text", ALIGN_BYTES):
            whole, a, b = _both(chunks, _texts(batch))
            pa_, pb_ = _overlaps(a, b)
            together = a.end[pa_] == b.end[pb_]
            la, lb = pa_[together], pb_[together]
            ends_a, ends_b = np.zeros(len(a.id), np.int64), np.zeros(len(b.id), np.int64)
            ends_a[la], ends_b[lb] = 1, 1
            rows = len(whole)
            n_overlaps = np.bincount(a.doc[pa_], minlength=rows)
            n_links = np.bincount(a.doc[la], minlength=rows)
            links, times = np.unique((a.doc[la] * width + a.id[la]) * width + b.id[lb], return_counts=True)
            cuts = pa.array(np.searchsorted(links, np.arange(rows + 1) * width ** 2), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int32())) for x in (links // width % width, links % width, times)]
            digests = _group_digests(a, b, ends_a, ends_b, strings, width)
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array(x, pa.int64()) for x in (a.n, b.n, n_links, n_overlaps)),
                 pa.array(digests, pa.string()), *lists],
                [*names, "n_a", "n_b", "n_groups", "n_overlaps", "groups_sha256", "a", "b", "k"])
    return run


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _sent(docs: DataFrame, model_a: bytes, model_b: bytes):
    sc = docs.sparkSession.sparkContext
    return sc.broadcast(model_a), sc.broadcast(model_b)


def aligned(docs: DataFrame, model_a: bytes, model_b: bytes) -> DataFrame:
    """``doc_id, text`` -> one row per text: ``n_a, n_b, n_groups, n_overlaps, groups_sha256`` and
    its distinct linked pairs as three arrays ``a, b, k`` (ids of both sides, times). The models
    are tokenizer files (bounded)."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(_aligner(*_sent(docs, model_a, model_b)),
                           f"doc_id {_kind(docs)}, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_overlaps bigint, "
                           "groups_sha256 string, a array<int>, b array<int>, k array<int>")


def overlaps(docs: DataFrame, model_a: bytes, model_b: bytes) -> DataFrame:
    """The alignment itself, one row per pair of tokens that share a byte: ``doc_id, a_pos, b_pos``
    (positions in the text's tokens), ``a_id, b_id``, the shared byte range ``lo, hi`` (of blank +
    text, hi exclusive), and ``linked`` where both tokens end there."""
    sent_a, sent_b = _sent(docs, model_a, model_b)

    def run(batches):
        chunks = _Chunks(_byte_level(sent_a.value), _pieces(sent_b.value))
        for batch in steps(batches, "text", ALIGN_BYTES):
            _, a, b = _both(chunks, _texts(batch))
            pa_, pb_ = _overlaps(a, b)
            doc = a.doc[pa_]
            first = a.start[np.minimum(a.base, max(len(a.id) - 1, 0))][doc] if len(pa_) else np.zeros(0, np.int64)
            lo, hi = np.maximum(a.start[pa_], b.start[pb_]) - first, np.minimum(a.end[pa_], b.end[pb_]) - first
            cols = [pa_ - a.base[doc], pb_ - b.base[doc], a.id[pa_], b.id[pb_], lo, hi]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), *(pa.array(c, pa.int64()) for c in cols), pa.array(a.end[pa_] == b.end[pb_])],
                ["doc_id", "a_pos", "b_pos", "a_id", "b_id", "lo", "hi", "linked"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {_kind(docs)}, a_pos bigint, b_pos bigint, a_id bigint, b_id bigint, lo bigint, hi bigint, linked boolean")


def link_counts(rows: DataFrame) -> DataFrame:
    """``aligned`` rows -> ``a, b, count, best``: links of each id pair over the corpus, and whether
    no other A id is linked to this B id more often. The maximum of a B id is one aggregate over
    at most as many rows as A has ids."""
    pairs = rows.select(F.explode(F.arrays_zip("a", "b", "k")).alias("p")).select("p.a", "p.b", "p.k")
    counts = pairs.groupBy("a", "b").agg(F.sum("k").alias("count"))
    top = counts.groupBy(F.col("b").alias("_b")).agg(F.max("count").alias("_top"))
    return counts.join(top, F.col("b") == F.col("_b")).select("a", "b", "count", (F.col("count") == F.col("_top")).alias("best"))


def _least_sent(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs have that count or more (above
    every count if even the highest class is larger). Reads 64 rows at most."""
    classes = counts.groupBy(F.floor(F.log2("count")).cast("int").alias("e")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = 62, 0
    for r in sorted(classes, key=lambda r: -r["e"]):
        total += r["n"]
        if total > most:
            break
        least = r["e"]
    return 1 << least


def _looked_up(sent):
    """Sums over each row's links of the pairs that were sent; the positions of the others."""
    def run(batches):
        codes, count, best = sent.value
        for batch in batches:
            cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("a")).to_numpy(zero_copy_only=False))]).astype(np.int64)
            a, b, k = (batch.column(c).flatten().to_numpy() for c in ("a", "b", "k"))
            code = (a.astype(np.int64) << _ID_BITS) | b
            at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
            hit = codes[at] == code if len(codes) else np.zeros(len(code), bool)
            total, bests = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
            total[hit] = count[at[hit]] * k[hit]
            bests[hit] = best[at[hit]] * k[hit]
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[cuts]) for x in (total, bests)]
            miss = np.flatnonzero(~hit)
            left = pa.array(np.searchsorted(miss, cuts), pa.int32())
            rest = [pa.ListArray.from_arrays(left, pa.array(x[miss], pa.int32())) for x in (a, b, k)]
            names = [c for c in batch.schema.names if c not in ("a", "b", "k")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(x, pa.int64()) for x in sums), *rest],
                                             [*names, "count_sum", "n_best", "a", "b", "k"])
    return run


def scored(rows: DataFrame, counts: DataFrame, most_sent: int = MOST_SENT) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` over a document's links to ``aligned`` rows. Both inputs
    should be stored tables: they are read more than once."""
    least = _least_sent(counts, most_sent)
    head = counts.where(F.col("count") >= least).select(
        (F.shiftleft(F.col("a").cast("bigint"), _ID_BITS) + F.col("b")).alias("code"), "count", "best").toArrow()
    order = np.argsort(head["code"].to_numpy())
    sent = rows.sparkSession.sparkContext.broadcast(
        (head["code"].to_numpy()[order], head["count"].to_numpy()[order], head["best"].to_numpy()[order].astype(np.int64)))
    kept = [c for c in rows.columns if c not in ("a", "b", "k")]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    found = rows.mapInArrow(_looked_up(sent), f"{types}, count_sum bigint, n_best bigint, a array<int>, b array<int>, k array<int>")
    if counts.where(F.col("count") < least).isEmpty():
        return found.drop("a", "b", "k")
    rare = found.select(F.col("row").alias("_row"), F.explode(F.arrays_zip("a", "b", "k")).alias("p")).select("_row", "p.a", "p.b", "p.k")
    more = (rare.join(counts.where(F.col("count") < least), ["a", "b"]).groupBy("_row")
            .agg(F.sum(F.col("count") * F.col("k")).alias("_count"), F.sum(F.col("best").cast("bigint") * F.col("k")).alias("_best")))
    both = found.drop("a", "b", "k").join(more, F.col("row") == F.col("_row"), "left")
    return both.withColumns({"count_sum": F.col("count_sum") + F.coalesce("_count", F.lit(0)),
                             "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0))}).select(*kept, "count_sum", "n_best")


def report(docs: DataFrame, model_a: bytes, model_b: bytes, most_sent: int = MOST_SENT) -> DataFrame:
    """One row per document: sizes, groups and how common its links are in the corpus."""
    rows = stored(aligned(docs, model_a, model_b), "aligned")
    counts = stored(link_counts(rows), "link-counts")
    return scored(rows, counts, most_sent).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256", "n_overlaps")
