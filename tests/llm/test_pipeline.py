"""The pipeline over a small table: decisions take effect stage by stage."""

import array
import weakref

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from chronopulse.llm import _common, bpe, linear

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        kept = stage(spark, kept, SF).cache()
        assert kept.columns == columns and 0 < kept.count() <= before, name
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(out) == set(texts)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text in list(texts.items())[:50]:
        assert out[i]["n_tokens"] == len(library.encode_ordinary(text))
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(labels[i]["quality"] == 1 and labels[i]["toxic"] == 0 for i in texts if i in labels) > 50
    toxic = lambda ids: sum(labels[i]["toxic"] for i in ids if i in labels)
    assert toxic(texts) < toxic(labels) / 2  # learnt from some eighty labelled texts only


def test_last_stage_decodes_every_text(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    out = corpus_pipeline.encode(spark, docs, SF).collect()
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(out) == len(texts)
    for r in out:
        ids = array.array("I", bytes(r["ids"])).tolist()
        assert ids == library.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(ids) and r["decodes"] is True
        assert library.decode(ids) == texts[r["doc_id"]]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    monkeypatch.setattr(bpe.TokenDecoder, "stream", lambda self, ids: ["other"])
    checked = []
    monkeypatch.setattr(bpe, "append_columns", lambda d, c, make, f: checked.extend(make()(["a text"])[2].to_pylist()))
    bpe.encode_checked(docs, path, public_tokenizers.PATTERN)
    assert checked == [False]


def test_stages_take_nulls_repeats_and_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = " ".join(f"w{k}" for k in range(40))
    odd = [(1_000_000, None), (1_000_001, ""), (None, words), (None, words), (1_000_002, words), (1_000_003, words), (1_000_003, words), (1_000_004, "é " * 5000)]
    rows = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, SF)
        assert out.columns == (docs.columns if name != "byte_bpe" else ["doc_id", "n_tokens", "ids", "decodes"])
        ids = [r["doc_id"] for r in out.collect()]
        if name == "near_copies":  # null ids stay; of texts without words and of equal texts the smallest id does
            assert sorted(ids, key=str) == [1_000_000, 1_000_002, 1_000_004, None, None]
        elif name in ("benchmark_passages", "byte_bpe"):
            assert sorted(map(str, ids)) == sorted(str(i) for i, _ in odd)
        assert stage(spark, rows.limit(0), SF).count() == 0


def test_workers_give_back_what_other_stages_learnt():
    """An encoder stays from task to task of its stage and goes when the process starts on another one, or on training."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoder = lambda: bpe._encoder(path, public_tokenizers.PATTERN)

    class Sample:
        """Runs the function of a training task in this process."""

        def repartition(self, n):
            return self

        def mapInPandas(self, run, schema):
            self.out = next(run(iter([])))
            return self

        def first(self):
            return {"w": self.out["w"][0]}

    for other in (lambda: _common.started(lambda: None), lambda: linear.train(Sample(), lambda texts, targets: np.zeros(1))):
        held = weakref.ref(_common.started(encoder))
        assert held() is not None and _common.started(encoder) is held()
        other()
        assert held() is None


def test_training_rows_are_packed_and_whole():
    """Rows come back as they were, whatever their indices and counts; usual ones take three bytes a feature."""
    rng = np.random.default_rng(1)
    usual = [(np.sort(rng.choice(1 << 18, 5000, replace=False)).astype(np.uint32), rng.integers(1, 200, 5000)) for _ in range(20)]
    odd = [
        (np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)),
        (np.array([0, 262_143]), np.array([255, 256])),
        (np.array([65_535, 131_071]), np.array([1, 70_000])),
        (np.array([65_536]), np.array([3])),
        (np.array([7, 9]), np.array([0.25, 0.75])),
    ]
    rows = linear.PackedRows(lambda idx, count: count)
    for idx, count in usual:
        rows.append(idx, count)
    held = sum(len(memoryview(x).cast("B")) for x in vars(rows).values() if isinstance(x, (bytearray, array.array)))
    assert held <= 3 * 20 * 5000
    for idx, count in odd:
        rows.append(idx, count)
    assert len(rows) == len(usual) + len(odd)
    for k, (idx, count) in enumerate(usual + odd):
        assert np.array_equal(rows[k][0], idx) and np.array_equal(rows[k][1], count)
