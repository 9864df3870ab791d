"""Alignment of two tokenizers, fill-in-the-middle and chat formatting: brute force and round trips."""

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from calforge.llm import alignment, bpe, chat, fim
from calforge.llm.queries import ALIGNED, FIM_SEED, QUOTED

from .conftest import ODD

RANKS = bpe.ranks_of(public_tokenizers.path("byte_bpe_50k.tiktoken"))
MODELS = [alignment.model_of(public_tokenizers.path(name)) for name in ALIGNED]
TRICKY = [(30, "<|endoftext|> and <s> </s> <unk> <0x41>"), (31, "holds ▁ itself"), (32, "a b  c\t\td\r\n\n"), (33, "👩‍👩‍👧 ẞß ﬁ Å é é"),
          (34, "<P> a\n"), (35, "x <S"), (36, "<M"), (37, ">\n<\n<P\n>\n"), (38, "\n"), (39, "\n\n\nend"), (40, "line\r\nline still the line\n"),
          (41, "< P><S >"), (None, "no id\nagain\n"), (42, "x\x00y")]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.fixture(scope="module")
def tricky(spark, odd):
    return odd.unionByName(spark.createDataFrame(TRICKY, "doc_id bigint, text string"), allowMissingColumns=True)


# -- 11: alignment -----------------------------------------------------------------------

def _alphabet():
    shown = [b for b in range(256) if chr(b).isprintable() and b not in range(0x7F, 0xA1) and b not in (0x20, 0xAD)]
    rest = iter(range(256, 512))
    return {(chr(b) if b in shown else chr(next(rest))): b for b in range(256)}


def tokens_by_definition(rows):
    """Of each text: tokens of both sides as (id, lo, hi), none unless both give the text back."""
    tok = Tokenizer.from_str(MODELS[0].decode())
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_proto=MODELS[1])
    letters = _alphabet()
    for d, t in rows:
        want = b" " + (t or "").encode()
        a = [(i, bytes(letters[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + (t or ""), add_special_tokens=False).ids]
        b = []
        for i in sp.encode(t or ""):
            p = sp.id_to_piece(i)
            m = re.fullmatch("<0x(..)>", p)
            b.append((i, bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode()))
        if not t or any(b"".join(x for _, x in side) != want for side in (a, b)):
            a, b = [], []
        sides = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            sides.append(out)
        yield d, *sides


def alignment_by_brute_force(rows):
    docs, counts = [], collections.Counter()
    for d, a, b in tokens_by_definition(rows):
        ends = sorted({z for *_, z in a} & {z for *_, z in b})
        links = [(i, j) for i, _, z in a for j, _, y in b if z == y]
        counts.update(links)
        groups, lo = [], 0
        for z in ends:
            groups.append("|".join(",".join(str(i) for i, x, y in side if lo <= x and y <= z) for side in (a, b)))
            lo = z
        shared = sum(max(x, u) < min(z, y) for _, x, z in a for _, u, y in b)
        docs.append((d, len(a), len(b), len(ends), links, shared, sha(";".join(groups)) if a else ""))
    best = collections.defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [(d, na, nb, ng, len(li), sum(counts[p] == best[p[1]] for p in li), sum(counts[p] for p in li), h, sh)
            for d, na, nb, ng, li, sh, h in docs]


SMALL = [(d, t) for d, t in ODD + TRICKY if len(t or "") < 5000]


@pytest.mark.parametrize("most_sent", [alignment.MOST_SENT, 40, 0])
def test_alignment(spark, docs, most_sent):
    df = spark.createDataFrame(SMALL, "doc_id bigint, text string").withColumn("row", F.lit("other")).unionByName(
        docs.where(F.length("text") < 1500).select("doc_id", "text"), allowMissingColumns=True)
    got = [tuple(r) for r in alignment.report(df, *MODELS, most_sent=most_sent).collect()]
    same(got, alignment_by_brute_force(texts(df)))


def test_alignment_of_long_texts_and_of_no_rows(odd, none):
    got = {r["doc_id"]: r for r in alignment.report(odd.where("length(text) > 5000"), *MODELS).collect()}
    assert got[8]["n_groups"] > 20_000 and got[7]["n_a"] > 0
    assert alignment.report(none, *MODELS).isEmpty() and alignment.overlaps(none, *MODELS).isEmpty()


def test_overlaps_are_all_pairs_that_share_a_byte(spark):
    rows = [(i, t) for i, (_, t) in enumerate(SMALL)]
    got = [tuple(r) for r in alignment.overlaps(spark.createDataFrame(rows, "doc_id bigint, text string"), *MODELS).collect()]
    want = [(d, p, q, i, j, max(x, u), min(z, y), z == y) for d, a, b in tokens_by_definition(rows)
            for p, (i, x, z) in enumerate(a) for q, (j, u, y) in enumerate(b) if max(x, u) < min(z, y)]
    same(got, want)


# -- 12: fill in the middle ----------------------------------------------------------------

def cut_by_definition(d, t, rate=100, spm=50):
    t, units = t or "", re.findall(r"[^\n]*\n|[^\n]+", t or "")
    n, x = len(units), sha(f"{FIM_SEED}:{'' if d is None else d}")
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    lo, hi = sorted(k % (n + 1) for k in h[:2])
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not t or any(k in t for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return d, n, "plain", None, None, t
    return (d, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (d, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize(("which", "rate"), [("docs", 100), ("tricky", 100), ("tricky", 40), ("none", 100)])
def test_fill_in_middle(which, rate, request):
    df = request.getfixturevalue(which)
    got = fim.restored(fim.transformed(df, FIM_SEED, rate)).collect()
    same([tuple(r)[:6] for r in got], [cut_by_definition(d, t, rate) for d, t in texts(df)])
    same([(r["doc_id"], r["restored"]) for r in got], [(d, t or "") for d, t in texts(df)])


def test_shifts_do_not_depend_on_windows():
    rng = np.random.default_rng(5)
    starts = np.sort(rng.integers(0, 400, 60))
    starts[0] = 0
    shifts = rng.integers(-100, 100, 60)
    whole = fim._displaced(starts, shifts, 0, 400)
    assert (whole == np.arange(400) + shifts[np.searchsorted(starts, np.arange(400), "right") - 1]).all()
    assert (np.concatenate([fim._displaced(starts, shifts, i, min(i + 7, 400)) for i in range(0, 400, 7)]) == whole).all()


# -- 13: chat ------------------------------------------------------------------------------

TURNS = [(1, 0, "system", "be brief"), (1, 1, "user", "hi <|im_end|>"), (1, 2, "assistant", QUOTED), (1, 3, "assistant", r"<\|im_end|> <\\|im_start|> <|im_end|"),
         (2, 0, "user", None), (2, 1, "assistant", ""), (2, 2, None, "x"), (2, 3, "a\nb\\n", "role with breaks"), (None, 0, "user", "no id"),
         (None, None, "assistant", "no turn"), (3, 5, "assistant", "tie"), (3, 5, "assistant", "tie"), (3, 5, "user", "tie"),
         (4, 1, "assistant", "long " * 40_000), (4, 0, "user", "é漢字👩‍👩‍👧\n\n"), (5, 0, "assistant", "<<|im_start|>|im_end|>")]


def chats_by_definition(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    for c, turns in convs.items():
        turns.sort()
        learned = "".join(t for _, _, r, _, t in turns if r == "assistant")
        size = sum(24 + len(r.replace("\\", "\\\\").replace("\n", "\\n")) + len(re.sub(r"<(\\*)\|(im_start|im_end)\|>", r"<\\\1|\2|>", t)) for _, _, r, _, t in turns)
        yield c, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, _, t in turns)), len(learned), sha(learned), size


@pytest.mark.parametrize("part", [chat.PART_TOKENS, 8])
def test_chats_are_read_back(spark, part):
    df = spark.createDataFrame(TURNS, "conv_id bigint, turn bigint, role string, text string")
    df = df.withColumn("ids", F.lit("other")).withColumn("key", F.lit(3)).withColumn("part", F.lit(1)).withColumn("trained", F.lit(0))
    parts = chat.formatted(df, RANKS, public_tokenizers.PATTERN, part_tokens=part)
    assert parts.groupBy("conv_id").count().where("count > 1").isEmpty() == (part > 8)
    same([tuple(r) for r in chat.read_back(chat.in_order(parts), RANKS).collect()], list(chats_by_definition(TURNS)))
    same([tuple(r) for r in chat.read_back(parts, RANKS).collect()], list(chats_by_definition(TURNS)))


def test_the_mask_covers_what_the_assistant_says(spark):
    df = spark.createDataFrame([(1, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(50)], "conv_id bigint, turn bigint, role string, text string")
    whole = chat.formatted(df, RANKS, public_tokenizers.PATTERN).collect()
    assert [r["part"] for r in whole] == [0]
    start, end = chat.reserved_ids(RANKS)
    ids, loss = np.frombuffer(whole[0]["ids"], "<u4"), np.frombuffer(whole[0]["loss"], np.uint8)
    assert (ids == start).sum() == (ids == end).sum() == 50 and not loss[(ids == start) | (ids == end)].any()
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe._encoding(RANKS, public_tokenizers.PATTERN)._mergeable_ranks,
                            special_tokens={chat.START: start, chat.END: end})
    assert enc.decode(ids.tolist()).startswith("<|im_start|>assistant\nturn 0<|im_end|>\n<|im_start|>user\n")
    assert enc.decode(ids[loss.astype(bool)].tolist()) == "".join(f"turn {i}" for i in range(0, 50, 2))


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.read_back(chat.formatted(df, RANKS, public_tokenizers.PATTERN), RANKS).isEmpty()
