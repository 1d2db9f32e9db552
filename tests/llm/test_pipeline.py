import brute
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm.common import materialize


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_each_stage_on_its_own_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, made = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, sf), "test-stage")
        made.append((name, docs, out))
        docs = out
    (_, given, judged), (_, _, single), (_, _, cut), (_, _, clean), (_, _, packed) = made
    assert [n for n, *_ in made] == ["quality classifier", "minhash near-dedup", "suffix-array dedup",
                                     "benchmark decontamination", "packing"]
    assert all(df.columns == columns for df in (judged, single, cut, clean))
    before, after = _texts(given), _texts(judged)
    assert after.items() <= before.items() and 0 < len(after) < len(before)
    comp = brute.near_duplicates(after, 5, 80)
    texts = _texts(single)
    assert texts == {i: t for i, t in after.items() if comp[i][1] == i}
    raws = {i: (t or "").encode() for i, t in texts.items()}
    spans = brute.repeated_spans(list(raws.values()), 200)
    shorter = {r["doc_id"]: r for r in cut.collect()}
    assert shorter.keys() == texts.keys()
    for (i, raw), runs in zip(raws.items(), spans, strict=True):
        got, left = shorter[i]["text"], brute.cut(raw, runs).decode(errors="ignore")
        if not runs:
            assert got == texts[i]
        else:
            assert len(left) <= len(got) <= len(left) + 2 * len(runs)
            assert shorter[i]["n_chars"] == len(got)
    rest = {i: r["text"] for i, r in shorter.items()}
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = brute.contamination(list(rest.values()), items)
    kept = {i: t for (i, t), b in zip(rest.items(), bad, strict=True) if not b[3]}
    assert _texts(clean) == kept
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in kept.items()}
    got = {r[0]: r[1] for r in packed.groupBy("doc_id").sum("length").collect()}
    assert got == sizes


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").isEmpty() and not out.isEmpty()
