"""The pipeline against plain versions of its stages, and the queries' registration."""

from __future__ import annotations

import os
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from tidemark.llm import decontaminate, pii, quality  # noqa: E402

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_every_operator_is_registered_once():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "personal_data", "packing"]


def test_entry_imports_without_the_subpackage(tmp_path):
    """Without the llm folders and the pipeline the other queries stay."""
    import shutil
    import subprocess

    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(f"{root}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'movements' in q and not any(n.startswith('op') for n in q), q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    failed = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert failed.returncode and b"no_such_module" in failed.stderr


def expected_pieces(spark):
    """The pipeline's pieces (without their places) by plain Python."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    df = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in quality.quality(df).where("kept").collect()}
    for d, t in docs.items():
        w = brute.WORD.findall(t or "")
        if len(w) < 10 or 100 * brute.repeated_words(t or "") > 20 * len(w):
            assert d not in kept
    rows = [(d, t) for d, t in docs.items() if d in kept]
    rows = [(d, t) for (d, t), (_, _, c) in zip(rows, brute.jaccard_classes(rows, 80, 5), strict=True) if c == d]
    hit = {d for d, _ in brute.overlaps(rows, items, decontaminate.allowed)}
    rows = [(d, t) for d, t in rows if d not in hit]
    model = pii.train(spark)
    spans = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    out = set()
    for d, t in rows:
        assert {(s.start, s.kind, s.end) for s in spans[d]} >= set(brute.pii_base(t))
        clean, at = "", 0
        for s in spans[d]:
            if s.start >= at:
                clean += t[at:s.start] + f"[{pii.KINDS[s.kind].upper()}]"
            at = max(at, s.end)
        ids = np.array(library.encode(clean + t[at:], add_special_tokens=False).ids + [0], "<u4")
        out.add((d, len(ids), zlib.crc32(ids.tobytes())))
    return out


@needs_tables
def test_pipeline_equals_the_plain_stages(spark):
    """Each document's ids, put together again from its pieces."""
    from tidemark.llm import packing
    from public_tokenizers import path

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    docs = docs.cache()
    got: dict[int, list] = {}
    for r in packing.pack(docs, path("byte_bpe_50k.json"), with_ids=True).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
    whole = {d: np.array(sum((list(i) for _, i in sorted(p)), []), "<u4") for d, p in got.items()}
    assert {(d, len(i), zlib.crc32(i.tobytes())) for d, i in whole.items()} == expected_pieces(spark)
    piped = E.queries()["pipeline"](spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert {(r.doc_id, r.n) for r in piped.collect()} == {(d, len(i)) for d, i in whole.items()}


@needs_tables
def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_near_copies_are_linked_at_five_words_and_80_percent(spark):
    """The stage against brute force, on copies that 3 words at 90 percent keep."""
    words = [f"w{i}" for i in range(100)]
    other = [f"v{i}" for i in range(60)]
    rows = [(1, words[:50]), (2, [*words[:25], "x", *words[26:50]]),
            (3, other), (4, other + [f"t{i}" for i in range(9)]),
            (5, [f"u{i}" for i in range(100)]), (6, [f"u{i}" if i not in (30, 70) else "x" for i in range(100)]),
            (7, [f"u{i}" if i % 12 else "y" for i in range(100)]), (8, ["a", "b"]), (9, ["A", "b"])]
    rows = [(d, " ".join(w)) for d, w in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = {r.doc_id for r in corpus_pipeline.ngram_jaccard_join(spark, docs, SF).collect()}
    assert {2, 4, 6} < {d for d, _, c in brute.jaccard_classes(rows) if c == d}
    assert left == {d for d, _, c in brute.jaccard_classes(rows, 80, 5) if c == d} == {1, 3, 5, 7, 8}
