"""Known licences, and the cheap test that comes before the canonical form."""

import hashlib
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from tidelake.llm import license_scan

KNOWN = license_scan.known_digests()
SHARED = pathlib.Path("/usr/share/common-licenses")


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (r.license, r.line_licenses) for r in license_scan.scan(docs, KNOWN, ["doc_id"]).collect()}


def test_full_texts_and_notices_in_other_dress(spark):
    texts = [text for _, text in license_scan.TEXTS + license_scan.NOTICES]
    dressed = ["Copyright (c) 1999 A. Person\n" + t.upper().replace("LICENSE", "LICENCE").replace(" ", "  ") for t in texts]
    got = found(spark, texts + dressed)
    assert [got[k][0] for k in range(len(got))] == [name for name, _ in license_scan.TEXTS + license_scan.NOTICES] * 2


@pytest.mark.skipif(not SHARED.exists(), reason="no licence texts on this machine")
def test_texts_of_the_machine(spark):
    named = {"GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "Apache-2.0": "Apache-2.0", "MPL-2.0": "MPL-2.0", "BSD": "BSD-3-Clause"}
    files = [f for f in named if (SHARED / f).exists()]
    texts = [(SHARED / f).read_text(encoding="utf-8") for f in files]
    got = found(spark, texts + [t + "\nand one more line" for t in texts])
    assert [got[k][0] for k in range(len(got))] == [named[f] for f in files] + [None] * len(files)


def test_beginnings_never_hide_a_known_text(spark):
    """Texts of words that the equivalents change: all with a known digest pass the test of the beginning."""
    rng = random.Random(9)
    words = ["version", "2", "3.0", "creative commons attribution noncommercial", "all rights reserved", "a", "gnu general public license", "sub-licence", "https",
             "wilful", "whilst", "per cent", "programme", "honour", "organisation", "v", "cc", "copyright owner", "non-commercial", "judgement", "catalogue"]
    texts = sorted({" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(3000)})
    known = license_scan.known_digests(tuple(("x", t) for t in texts if license_scan.canonical_text(t)), ())
    units = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = units.select("text", license_scan.digest(license_scan.words_only(F.col("text")), known).alias("digest")).collect()
    for text, digest in rows:
        canonical = license_scan.canonical_text(text)
        assert not canonical or digest == hashlib.sha256(canonical.encode()).hexdigest(), text
    # One known text at a time, so that no other lets its beginning through.
    for text in rng.sample(texts, 300):
        canonical = license_scan.canonical_text(text)
        if canonical:
            words_before = " " + license_scan.re.sub(license_scan.NOT_WORDS, " ", text).replace(license_scan.RESERVED, "")
            head = words_before.lstrip(" ")[: license_scan.HEAD]
            allowed = license_scan.heads(license_scan.known_digests((("x", text),), ()))
            assert head.strip(" ") in allowed or "  " in head, text
