"""Alignment, language model scores and conversation repair against plain versions."""

from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from tidemark.llm import alignment, context_tree, conversation_repair  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

DOCS = [
    (1, "The quick brown fox, jumped over 12 lazy dogs.", "a"), (2, "The quick brown fox, jumped over 12 lazy dogs.", "b"),
    (3, None, "c"), (4, "", "d"), (5, " \t\n ", "e"), (None, "no id at all", "f"), (6, "naïve café ΑΣ \U0001f600 漢字 ▁ piece", "g"),
    (7, "<|endoftext|> </s> <s> <unk> <0x41>", "h"), (8, "ab " * 3000, "i"), (1, "The quick brown fox, jumped over 12 lazy dogs.", "a"),
    (9, "naïve café 漢字 \U0001f600 Ünïcödé", "j"), (10, "word\x0bword\x0cword\x00nul", "k"), (11, "  two  spaces  ", "l"), (12, "A", "m"),
]
# columns with the names operators use inside
CLASHES = {"block": 1, "slot": -1, "kind": "x", "blob": None, "train": False, "pairs": "p"}


def table(spark, rows=DOCS):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)
    return df.withColumns({n: F.lit(v) for n, v in CLASHES.items()})


def near(got, want):
    """Equal rows, numbers to a billionth."""
    key = lambda r: tuple("" if x is None else f"{x:.4f}" if isinstance(x, float) else str(x) for x in r)
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert [x for x in g if not isinstance(x, float)] == [x for x in w if not isinstance(x, float)]
        assert [x for x in g if isinstance(x, float)] == pytest.approx([x for x in w if isinstance(x, float)], rel=1e-9)


# Alignment -------------------------------------------------------------------

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 64, "slot_bytes": 256}])
def test_alignment_equals_brute_force(spark, sizes):
    got = alignment.align(table(spark), *PATHS, **sizes).collect()
    near(got, brute.alignments([r[:2] for r in DOCS], *PATHS))


@needs_tables
def test_alignment_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    short = [(d, t) for d, t in rows if len(t or "") < 6000]
    df = spark.createDataFrame(short, "doc_id long, text string").repartition(4)
    near(alignment.align(df, *PATHS, block_bytes=50_000, slot_bytes=20_000).collect(), brute.alignments(short, *PATHS))


def test_alignment_of_nothing(spark):
    assert alignment.align(table(spark).where("false"), *PATHS).count() == 0
    assert [r[1:] for r in alignment.align(table(spark, [(1, None, "")]), *PATHS).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_pair_counts(spark):
    """Documents and links of pairs, from bitmaps in several blocks."""
    rows = [(1, "aa aa aa"), (2, "aa"), (3, "bb aa"), (4, "aa aa aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    blocks = alignment.invert_documents(df, *PATHS, block_bytes=4)
    got = {(r.a_id, r.b_id): (r.documents, r.links) for r in alignment.pair_counts(blocks).collect()}
    t = alignment.tokenizers_of(*PATHS)
    pair = t.encode_a(" aa")[0], t.b.encode("aa")[0]
    assert got[pair] == (4, 8)
    assert max(n for n, _ in got.values()) == 4


def test_bitmaps_round_trip():
    """Dense and sparse pairs, and how often documents hold them."""
    import numpy as np
    rng = np.random.default_rng(3)
    for n_docs in (1, 7, 8, 900):
        runs = [np.sort(rng.choice(n_docs, size=k, replace=False)) for k in sorted({1, n_docs, max(1, n_docs // 3), max(1, n_docs // 50)})]
        docs, sizes = np.concatenate(runs), np.array([len(r) for r in runs])
        times = rng.integers(1, 70, len(docs))
        starts = np.cumsum(sizes) - sizes
        blob = alignment.pack_bitmaps(docs, times, starts, n_docs)
        pair, doc, n = alignment.postings(blob)
        assert doc.tolist() == docs.tolist() and n.tolist() == times.tolist()
        assert pair.tolist() == np.repeat(np.arange(len(runs)), sizes).tolist()
        counts, links = alignment.popcounts(blob)
        assert counts.tolist() == sizes.tolist() and links.tolist() == np.add.reduceat(times, starts).tolist()


# Language model --------------------------------------------------------------


def scores(df, **options):
    return context_tree.score(df, **options).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 64, "slot_bytes": 100}])
def test_scores_equal_a_plain_tree(spark, sizes):
    rows = [r for r in DOCS if r[0] != 8] + [(8, "ab " * 40, "i"), (35, "the quick fox over dogs", "held"), (40, "A quick word", "n")]
    near(scores(table(spark, rows), **sizes), brute.language_scores([r[:2] for r in rows], context_tree.DEPTH))


def test_scores_of_nothing_and_without_training(spark):
    from pyspark.sql import functions as F
    assert context_tree.score(table(spark).where("false")).count() == 0
    got = context_tree.score(table(spark, [(1, "ab", "")]), train=F.lit(False)).first()
    assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens, got.n_bytes) == (True, 2, 0, 0, 4)
    assert got.score == pytest.approx(-32 * 0.30102999566)  # every choice is a half


def test_log_gamma():
    import math

    import numpy as np
    x = np.array([0.5, 1, 1.5, 2, 7.5, 8, 100.5, 1e6, 3e9])
    assert context_tree._log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)


@needs_tables
def test_held_out_texts_are_predicted(spark):
    """Code length per byte: letters alone take over 4 bits."""
    got = context_tree.score(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").agg({"score": "sum", "n_bytes": "sum"}).first()
    assert -got["sum(score)"] / got["sum(n_bytes)"] * 3.3219280948873623 < 3


# Conversations ---------------------------------------------------------------


def small_conversations(seed: int, n: int, most_rows: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Yes.", "No", " \n", "", "Why? ", "ok", None, "Fine!\t"]
    roles = ["user", "assistant", "system", "tool", "usr", None, ""]
    weights = [8, 8, 2, 1, 1, 1, 1]
    return [(c, rng.choice([i, i, i, i, i + 1, None]), rng.choices(roles, weights)[0], rng.choice(texts) if rng.random() < .7 else f"t{c}{i}.")
            for c in range(n) for i in range(rng.randint(0, most_rows))]


def solved(rows):
    """The operator's dynamic program without a grammar."""
    bad = brute.faults(rows)
    symbols = "".join("d" if f in ("blank", "duplicate") else (lambda s: s.upper() if f else s)(r[:1] if r[:1] in tuple("sua") else "x")
                      for (r, _), f in zip(rows, bad, strict=True))
    return conversation_repair.Grammar([]).solve(symbols)


def test_dynamic_program_equals_all_edits():
    """Every symbol string of up to three rows, and longer ones at random."""
    rng = random.Random(5)
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("{}.", "{}")] + [("user", " ")]
    import itertools
    cases = [list(c) for n in range(4) for c in itertools.product(kinds, repeat=n)]
    cases += [[rng.choice(kinds) for _ in range(4)] for _ in range(150)]
    for case in cases:
        rows = [(r, t.format(i)) for i, (r, t) in enumerate(case)]
        assert solved(rows) == brute.cheapest_repair(rows, 2)[:2], rows


def test_rules_change_nothing():
    rng = random.Random(9)
    rules, symbols = [], "dsuaxSUAX"
    for i in range(40):
        alphabet = symbols + "".join(s for _, s in rules)
        rules.append((rng.choice(alphabet) + rng.choice(alphabet), chr(0xE000 + i)))
    plain, ruled = conversation_repair.Grammar([]), conversation_repair.Grammar(rules)
    for n in (0, 1, 2, 5, 20, 300):
        for _ in range(20):
            s = "".join(rng.choice("uauauauasdUAxS"[:rng.randint(2, 14)]) for _ in range(n))
            assert plain.solve(s) == ruled.solve(s)


def test_ropes_compare_as_their_texts():
    rng = random.Random(2)
    def rope(text):
        if len(text) < 2 or rng.random() < .2:
            return conversation_repair.Rope(text)
        cut = rng.randint(0, len(text))
        return conversation_repair.Rope(None, rope(text[:cut]), rope(text[cut:])) if 0 < cut < len(text) else conversation_repair.Rope(text)
    for _ in range(500):
        a = "".join(rng.choice("DIK") for _ in range(rng.randint(0, 120)))
        b = a[:rng.randint(0, len(a))] + "".join(rng.choice("DIK") for _ in range(rng.randint(0, 5)))
        x, y = rope(a), rope(b)
        assert (str(x), str(y), x < y, y < x) == (a, b, a < b, b < a)


def repaired_rows(spark, rows, ids=None, **options):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema).repartition(3)
    named = spark.createDataFrame([(i,) for i in ids], "conv_id long") if ids is not None else None
    from pyspark.sql import functions as F
    df = df.withColumns({"symbols": F.lit("x"), "h": F.lit(1), "is_row": F.lit(False), "audit": F.lit("K")})
    return conversation_repair.digest_repaired(conversation_repair.repaired(df, named, **options)).collect()


@pytest.mark.parametrize("options", [{}, {"rounds": 0}, {"rounds": 3, "per_round": 2}])
def test_repair_equals_all_edits(spark, options):
    rows = small_conversations(1, 60, 4)
    # turns of one conversation with one number are in a defined order: keep one of each here
    rows = list({(c, n): (c, n, r, t) for c, n, r, t in rows}.values())
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (1000, 0, "user", "Same."), (1000, 0, "user", "Same.")]
    ids = sorted({r[0] for r in rows if r[0] is not None}) + [None, 5000]
    plain = [(c, n, " " if r is None else r, " " if t is None else t) for c, n, r, t in rows]
    want = brute.repaired_conversations(plain, ids, lambda own: brute.cheapest_repair(own, 2))
    got = repaired_rows(spark, rows, ids, **options)
    near(got, want)


def test_damage(spark):
    rows = small_conversations(3, 200, 5)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in conversation_repair.damaged(df).collect()]
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(brute.damaged(rows), key=key)


def test_a_long_conversation(spark):
    """Two hundred thousand rows: repaired as its parts are."""
    n = 200_000
    rows = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
                                     "if(id % 1000 = 500, '', concat('t', id, '.')) AS text")
    got = conversation_repair.digest_repaired(conversation_repair.repaired(rows)).first()
    # each blank user row goes, and the answer before or after it with it
    assert (got.blank, got.cost, len(got.audit)) == (n // 1000, 2 * 2 * n // 1000, n)
    assert got.audit.count("D") == 2 * n // 1000


def test_repair_of_nothing(spark):
    assert repaired_rows(spark, []) == []
    got = repaired_rows(spark, [], [4])
    assert [tuple(r) for r in got] == [(4, 0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")]


@needs_tables
def test_repair_of_the_given_conversations(spark):
    import __spark_entry__ as E
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = brute.damaged(rows)
    ids = sorted({r[0] for r in rows})

    def one_at_a_time(own):
        cost, audit = solved(own)
        return cost, audit, brute_turns(own, audit)

    near(E.queries()["op13_conversation_repair"](spark, SF).collect(), brute.repaired_conversations(hurt, ids, one_at_a_time))


def brute_turns(rows, audit):
    out, rows = [], iter(rows)
    for edit in audit:
        wanted = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((wanted, ""))
            continue
        role, text = next(rows)
        if edit != "D":
            out.append((role if edit == "K" else wanted, text))
    return out
