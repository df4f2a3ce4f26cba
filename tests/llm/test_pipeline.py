"""The stages of the pipeline, one after the other, on rows made for their edges."""

import hashlib
import random

import corpus_pipeline
from tokenizers import Tokenizer

from tidelake.llm.queries import TOKENIZER_FILE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def prose(rng, n):
    return " ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.choice('klmnrst')}{k}" for k in rng.sample(range(1000), n))


def test_stages_keep_clean_documents_and_take_out_the_rest(spark, tmp_path):
    rng = random.Random(9)
    plain, leaked, first = prose(rng, 90), prose(rng, 60), prose(rng, 120)
    near = first.split()
    near[7] = "changed"
    line = prose(rng, 20)
    texts = [
        (1, plain), (1, plain), (2, first), (3, " ".join(near)), (4, None), (5, ""), (6, "too short"),
        (7, f"{prose(rng, 80)} {leaked} {prose(rng, 20)}"), (8, f"{prose(rng, 80)}\n{line}"), (9, f"{prose(rng, 80)}\n{line.upper()}"),
        (None, prose(rng, 70)), (10, "same same same " * 40), (3, prose(rng, 75)),
    ]
    rows = [(k, t, "en", "web", len(t) if t else None, "x") for k, t in texts]
    folder = str(tmp_path / "tables")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, leaked), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER_FILE)
    second = texts[9][1].split("\n")[0]  # its line stands in document 8 already
    want = [(1, plain), (2, first), (8, texts[8][1]), (9, second), (None, texts[10][1]), (3, texts[12][1])]

    def ids(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    def digest(rows):
        return sorted((str(k), hashlib.sha256(str(x).encode()).hexdigest()) for k, x in rows)

    assert digest((r.doc_id, r.ids) for r in got) == digest((k, ids(t)) for k, t in want)
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_stages_take_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "tables")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding",
    ]
