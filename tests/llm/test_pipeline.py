"""The pipeline against slow versions of its stages, one after another."""

import struct
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import slow as slow_hits
from tests.llm.test_operators import slow_lines
from tests.llm.test_simhash import slow_components, slow_fingerprint


def words(i, n):
    return " ".join(f"w{i}x{k}" for k in range(n))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    passage = words(900, 14)
    rows = [(i, f"{words(i, 30 + i)}\nShared line\n{words(i + 500, 9)}", "en" if i % 2 else "de", "a", 1) for i in range(14)]
    rows += [(20, rows[3][1], "en", "a", 1), (21, rows[3][1] + " ", None, "b", 1), (22, "123 ...", "en", "a", 1), (23, None, None, None, None),
             (24, f"{words(24, 20)} {passage} {words(25, 5)}", "en", "a", 1), (25, "", "en", "a", 1), (None, words(26, 12), "en", "a", 1),
             (27, words(27, 3000), "de", "a", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "decontamination", "packing"]


def test_run_is_the_slow_one(spark, sf_dir):
    docs = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = [r for r in docs if r[1] and any(c.isalpha() for c in r[1])]
    docs = [(i, t, None) for i, _, _, t in slow_lines(docs, 10)]
    fps = [(i, slow_fingerprint(t)) for i, t, _ in docs]
    docs = [r for r, c in zip(docs, slow_components(fps)) if r[0] == c]
    docs = [r for r in docs if not slow_hits(r[1], items)[1]]
    full = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: full.encode(t, add_special_tokens=False).ids + [2] for i, t, _ in docs}
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got[r.doc_id].append(r)
    have = {}
    for i, parts in got.items():
        parts.sort(key=lambda r: r.start)
        have[i] = [x for r in parts for x in struct.unpack(f"<{r.length}I", bytes(r.ids))]
    assert have == want and 24 not in want and 20 not in want and len(want) == 16


def test_stages_keep_columns_and_stand_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", "1 as n_lines", "'x' as fp", "2 as carried", "3 as row").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "fp", "carried", "row"], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect() == []
