"""Language identification by compression.

For every language a zstandard raw-content dictionary is made of labelled texts. A text is compressed
with each of them, in blocks short enough for the dictionary to matter throughout, and belongs to the
language with the smallest total. The score is the margin to the second smallest, as a share of it;
below ``NARROW`` the decision is not ``accepted``.

The dictionaries are fitted on a bounded sample: of each language ``SAMPLE_TEXTS`` texts, lowest hash of
the id first, ``SAMPLE_CHARS`` characters of each. At most ``MOST_LANGUAGES`` languages are supported.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.tables import map_arrow

SAMPLE_TEXTS = 48
SAMPLE_CHARS = 3000
MOST_LANGUAGES = 500
BLOCK_BYTES = 8192
LEVEL = 3
NARROW = 0.02
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")


def dictionaries(labelled: DataFrame) -> dict[str, bytes]:
    """Raw dictionary content by language, from rows (doc_id, text, lang); NULLs are not used."""
    usable = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).dropna()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "sample")
    sampled = usable.select("doc_id", "lang", F.substring("text", 1, SAMPLE_CHARS).alias("sample"))
    picked = sampled.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE_TEXTS)
    if usable.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    texts: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", "rank").collect():
        texts.setdefault(row["lang"], []).append(row["sample"])
    return {lang: "\n".join(parts).lower().encode() for lang, parts in texts.items()}


class Classifier:
    def __init__(self, contents: dict[str, bytes]):
        self.packers = {}
        for lang, content in sorted(contents.items()):
            raw = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.packers[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)

    def classify(self, text: str | None) -> tuple[str, float]:
        if not text or not self.packers or not LETTER.search(text):
            return UNKNOWN, 0.0
        data = text.lower().encode()
        blocks = [data[at : at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
        sizes = sorted((sum(len(packer.compress(block)) for block in blocks), lang) for lang, packer in self.packers.items())
        (best, lang), second = sizes[0], sizes[1][0] if len(sizes) > 1 else None
        return lang, 1.0 if second is None else (second - best) / second


def classifier(contents: dict[str, bytes], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Classifier(contents)
        for batch in batches:
            told = [found.classify(text.as_py()) for text in batch.column("text")]
            langs, scores = pa.array([x for x, _ in told], pa.string()), pa.array([y for _, y in told], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), langs, scores], names=[*names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, labelled: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred, score, and accepted.

    A text that is NULL or has no letter is "und" with score 0, and so is every text if nothing could be
    learned; these are not accepted. Ties go to the language that sorts first. Columns of ``keep`` with
    the names of outputs give way.
    """
    keep = [c for c in keep if c not in ("lang_pred", "score", "accepted")]
    docs = docs.withColumn("text", F.col("text").cast("string"))
    read = list(dict.fromkeys([*keep, "text"]))
    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*(docs.schema[c] for c in keep), *more])
    told = map_arrow(docs.select(*read), classifier(dictionaries(labelled), keep), schema)
    return told.withColumn("accepted", (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= NARROW))
