"""The operators on handmade rows, against brute force, and at the edges of their input."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelake.llm import bpe, decontamination, language_id, license_scan, line_dedup, linking, parity_join
from tidelake.llm import quality_classifier, quality_rules, quotation_links, sharding
from tidelake.llm.queries import TOKENIZER_FILE
from tidelake.llm.tables import map_arrow, written
from tidelake.llm.textkit import slices

SCHEMA = "doc_id long, text string, lang string, n_words string, score string, shard string, gone string"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def frame(spark, texts, lang="en"):
    """Documents with columns that clash with names of outputs."""
    rows = [(k, text, lang, "x", "y", "z", "w") for k, text in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = [(1, None), (2, ""), (3, "  \n "), (4, "one"), (5, "one"), (6, "a b c"), (7, "A B c"), (None, "a b c"), (8, "!!! ..."), (8, "!!! ...")]
    base = sentence(rng, 120).split()
    for k in range(20, 50):
        near = list(base)
        for _ in range(k % 6):
            near[rng.randrange(len(near))] = "zz%d" % k
        out.append((k, " ".join(near)))
    out += [(k, sentence(rng, rng.randint(1, 40))) for k in range(60, 100)]
    out.append((100, sentence(rng, 20_000)))
    return out


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def smallest_reachable(items, linked):
    parent = {k: k for k in items}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in items}


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = dict(map(tuple, linking.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 160)}
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_join_finds_every_link(spark, texts):
    got = parity_join.near_duplicates(frame(spark, texts)).collect()
    sets = {k: shingles(text) for k, text in texts if k is not None}

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return bool(sets[a]) and 100 * both >= 75 * len(sets[a] | sets[b])

    want = smallest_reachable(sorted(sets), linked)
    assert len(got) == len(texts)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {(k, len(sets[k]), want[k]) for k in sets}
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(1, 6)]


def test_jaccard_join_of_nothing(spark):
    assert parity_join.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 6, 15, 40, 300])
def test_near_sets_share_a_token(n):
    """The pigeonhole argument itself, for pairs right at the bound."""
    rng = np.random.default_rng(n)
    is_common = rng.random(1 << parity_join.COMMON_BITS) < 0.3
    for _ in range(200):
        union = np.unique(rng.integers(0, 1 << 64, size=n, dtype=np.uint64))
        apart = rng.permutation(len(union))[: len(union) // 4]
        side = rng.random(len(apart)) < rng.random()
        left, right = np.delete(union, apart[side]), np.delete(union, apart[~side])
        assert 100 * (len(union) - len(apart)) >= 75 * len(union)
        assert np.intersect1d(parity_join.set_tokens(left, is_common), parity_join.set_tokens(right, is_common)).size


def test_bpe_equals_the_library(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER_FILE)
    rng = random.Random(2)
    pool = [chr(c) for c in (*range(9, 14), *range(28, 127), *range(160, 600), *range(0x300, 0x500), *range(0x4E00, 0x4E20), 0x1F600)]
    texts = ["", " \n", "it's DON'T we've", "ΑΣ όσος İ ẞ ﬁ", "a\x1cb\x1f c\x85d", "x<|endoftext|>y <|startoftext|><|x|>", "a" * 3000, "qzjx vqvz", "é́a 12½²"]
    texts += ["".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(300)]
    rows = bpe.encode_decode(frame(spark, [*enumerate(texts), (-1, None)]).withColumn("ids", F.lit("clash")), TOKENIZER_FILE).collect()
    got = {r.doc_id: (r.ids, r.decoded) for r in rows}
    for k, text in enumerate(texts):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert got[k] == (ids, tokenizer.decode(ids, skip_special_tokens=False)), repr(text)
    assert got[-1] == ([], "")
    assert bpe.encode_decode(frame(spark, []), TOKENIZER_FILE).count() == 0


def test_fragments_are_cut_where_no_token_joins():
    codec = bpe.Codec(open(TOKENIZER_FILE, encoding="utf-8").read())
    assert codec.fragments("abqzcd") == ["abq", "zcd"] and codec.fragments("x") == ["x"]


def test_line_dedup_keeps_first_of_each_group(spark):
    rng = random.Random(3)
    long = sentence(rng, 200).split()
    other = list(long)
    other[50] = "changed"
    texts = [
        (1, "Same line here!\nunique one\n---\n---"),
        (2, "same LINE, here\n" + " ".join(long)),
        (3, " ".join(other) + "\nsame line here\n\nlast"),
        (4, None), (5, ""), (6, "numbers 12 of 34"), (7, "numbers 99 of 11\n"), (None, "unique one\nnew"), (3, "same line here"),
    ]
    got = collections.Counter((r.doc_id, r.text, r.n_dropped) for r in line_dedup.dedup_lines(frame(spark, texts)).collect())
    want = [
        (1, texts[0][1], 0), (2, " ".join(long), 1), (3, "\nlast", 2), (4, None, 0), (5, "", 0),
        (6, "numbers 12 of 34", 0), (7, "", 1), (None, "new", 1), (3, "", 1),
    ]
    assert got == collections.Counter(want)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def encoded(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def test_simhash_of_long_lines_follows_the_same_rule():
    line = " ".join(f"word{k % 97}x" for k in range(400))
    got = line_dedup.Lines(*encoded([line])).simhashes()[0]
    lines = line_dedup.Lines(*encoded([line]))
    bits = np.unpackbits(lines.hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0) > 200
    want = sum(1 << (8 * p + 7 - k) for k in range(8) for p in range(8) if bits[8 * k + p])
    assert int(got) == want


def test_decontamination(spark):
    rng = random.Random(4)
    item, short, other = sentence(rng, 45), "two words", sentence(rng, 30)
    near = item.split()
    near[30] = "changed"
    far = item.split()
    far[10] = far[20] = far[30] = "changed"
    pad = [sentence(rng, 30) for _ in range(6)]
    texts = [
        (1, f"{pad[0]} {item.upper()}. {pad[1]}"), (2, f"{pad[2]}\n{' '.join(near)}, {pad[3]}"), (3, f"{pad[4]} {' '.join(far)} {pad[5]}"),
        (4, None), (5, ""), (6, item), (7, "now two words more"), (8, sentence(rng, 300)), (None, item), (6, item),
    ]
    benchmark = spark.createDataFrame([(10, item), (11, short), (12, other), (13, None), (None, "x"), (10, item), (14, "")], "item_id long, text string")
    got = collections.Counter((r.doc_id, r.item_id, r.word) for r in decontamination.leaked_items(frame(spark, texts), benchmark).collect())
    assert got == collections.Counter([(1, 10, 30), (2, 10, 30), (6, 10, 0), (6, 10, 0), (7, 11, 1), (None, 10, 0)])
    docs = frame(spark, texts)
    assert decontamination.without_leaks(docs, benchmark).columns == docs.columns
    assert {r.doc_id for r in decontamination.without_leaks(docs, benchmark).collect()} == {3, 4, 5, 8}
    assert decontamination.leaked_items(docs, benchmark.limit(0)).count() == 0 == decontamination.leaked_items(frame(spark, []), benchmark).count()


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 64, size=500, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, size=(500, 5), dtype=np.uint64))[:, :, None]
    asked = np.array([p ^ np.bitwise_or.reduce(f[: k % 6].ravel(), initial=0) for k, (p, f) in enumerate(zip(prints, flips, strict=True))], dtype=np.uint64)
    index = decontamination.SizeIndex(prints, np.arange(500), np.zeros(500, int))
    at, entry = index.within_radius(asked)
    distance = np.bitwise_count(asked[:, None] ^ prints[None, :])
    assert set(zip(at.tolist(), entry.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(distance <= 3)), strict=True))


def brute_counts(text):
    words, text = WORD.findall(text or ""), text or ""
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in collections.Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_base_rules(spark, texts):
    more = [(200, "a\nb\na\n\n\nb \nb"), (201, "x | ¼é# <b>\n" * 30), (202, "\n\n"), (203, "w " * 80)]
    docs = frame(spark, texts + more)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(docs, labels, ["doc_id", "n_words"]).collect()
    want = []
    for k, text in texts + more:
        c = brute_counts(text)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want.append((k, *c, failed, not failed))
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == collections.Counter(want)
    kept = quality_rules.kept_only(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(w[-1] for w in want)
    assert quality_rules.judge(frame(spark, []), labels, ["doc_id"]).count() == 0


def test_cutoffs_keep_false_rejection_low_and_need_labels(spark):
    rng = random.Random(6)
    clean = [(k, sentence(rng, 60)) for k in range(900)]
    junk = [(k, " ".join(w + "%%" for w in sentence(rng, 60).split())) for k in range(1000, 1020)]
    docs = frame(spark, clean + junk).unionByName(frame(spark, [(2000, junk[0][1])], lang="xx"))
    labels = spark.createDataFrame([(k, 1, 0) for k, _ in clean] + [(1000, 0, 0), (0, 0, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality_rules.judge(docs, labels, ["doc_id"]).where("kept").collect()}
    assert kept == {k for k, _ in clean} | {2000}  # too few labels in the other language: no cutoff there


def test_cutoffs_of_four_strata_with_few_hundred_labels_reject_junk(spark):
    rng = random.Random(8)
    rows, labels, junk = [], [], set()
    for at, lang in enumerate(["en", "fr", "de", "es", "rare"]):
        for k in range(at * 1000, at * 1000 + (60 if lang == "rare" else 300)):
            text = sentence(rng, 60)
            # One clean text in a hundred repeats half of its lines: a rule that would end the others' steps.
            rows.append((k, f"{text}\n{text[:40]} x\n{text[:40]} x" if k % 100 == 0 else text, lang, "", "", "", ""))
            labels.append((k, 1, 0))
        for k in range(at * 1000 + 900, at * 1000 + 910):
            words = sentence(rng, 60).split()
            rows.append((k, " ".join(w + "%" * (i % 2) for i, w in enumerate(words)), lang, "", "", "", ""))
            junk |= {k} if lang != "rare" else set()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality_rules.judge(docs, labels, ["doc_id"]).where("kept").collect()}
    assert not kept & junk and {4900, 4909} <= kept
    clean = {k for k, *_ in rows if k % 1000 < 900}
    assert len(clean - kept) <= 0.05 * len(clean)


def test_exact_binomial_tail():
    assert quality_rules.chance_at_most(0, 10, 0.1) == pytest.approx(0.9**10)
    assert quality_rules.chance_at_most(10, 10, 0.1) == pytest.approx(1.0)


def test_classifier_at_the_edges(spark):
    rng = random.Random(8)
    good = [(k, sentence(rng, 40)) for k in range(60)]
    bad = [(100 + k, " ".join(w.upper() + "!!" for w in sentence(rng, 40).split())) for k in range(60)]
    edge = [(300, None), (301, ""), (302, "123 !!"), (302, "123 !!")]
    docs = frame(spark, good + bad + edge)
    labelled = docs.where("doc_id < 200").withColumn("label", (F.col("doc_id") < 100).cast("int"))
    got = {r.doc_id: r for r in quality_classifier.classify(docs, labelled, labelled, ["doc_id", "score"]).collect()}
    assert all(got[k].predicted == 1 for k, _ in good) and all(got[k].predicted == 0 for k, _ in bad)
    assert got[300].score == got[301].score == 0.5
    assert {r.score for r in quality_classifier.classify(docs, labelled, labelled.limit(0), ["doc_id"]).collect()} == {0.5}
    assert quality_classifier.classify(frame(spark, []), labelled, labelled, ["doc_id"]).count() == 0


def test_language_by_shared_strings(spark):
    rng = random.Random(9)
    vocabulary = {lang: [sentence(rng, 1) + suffix for _ in range(150)] for lang, suffix in (("low", "ane"), ("high", "ung"))}
    rows = [(k, " ".join(rng.choices(vocabulary[lang], k=60)), lang) for k, lang in enumerate(["low", "high"] * 40)]
    learned = spark.createDataFrame([*rows[:40], (90, None, "low"), (91, "x", None)], "doc_id long, text string, lang string")
    docs = frame(spark, [(k, text) for k, text, _ in rows] + [(300, None), (301, ""), (302, "123 !!"), (302, "123 !!")])
    told = {r.doc_id: r for r in language_id.identify(docs, learned, ["doc_id", "score"]).collect()}
    assert all(told[k].lang_pred == lang for k, _, lang in rows)
    assert [told[k].lang_pred for k in (300, 301, 302)] == ["und"] * 3 and not told[302].accepted
    assert {r.lang_pred for r in language_id.identify(docs, learned.limit(0), ["doc_id"]).collect()} == {"und"}
    assert language_id.identify(frame(spark, []), learned, ["doc_id"]).count() == 0


def test_licences_by_canonical_digest(spark):
    mit = license_scan.MIT
    dressed = "Copyright (c) 2020 Someone\n\n" + mit.replace(",", " ;").upper().replace("SUBLICENSE", "sub-licence")
    texts = [(1, mit), (2, dressed), (3, mit + " and more"), (4, "// released under the MIT LICENCE\ncode\nReleased under the MIT License."), (5, None), (6, ""), (1, mit)]
    docs = frame(spark, texts).withColumn("license", F.lit("clash"))
    rows = license_scan.scan(docs, license_scan.known_digests(), ["doc_id", "license"]).collect()
    got = collections.Counter((r.doc_id, r.license, tuple(r.line_licenses), r.n_license_lines) for r in rows)
    assert got == collections.Counter([(1, "MIT", (), 0)] * 2 + [(2, "MIT", (), 0), (3, None, (), 0), (4, None, ("MIT",), 2), (5, None, (), 0), (6, None, (), 0)])
    assert license_scan.scan(frame(spark, []), license_scan.known_digests(), ["doc_id"]).count() == 0


def test_shards_fit_and_only_full_buckets_split(spark):
    rows = [(k, "x" * (k % 50)) for k in range(2000)] + [(7, "y" * 90)] * 60 + [(5000, "z" * 500), (None, "n"), (None, None)]
    docs = frame(spark, rows)
    limit = 400
    got = sharding.assign_shards(docs, limit).collect()
    assert len(got) == len(rows) and sum(r.row_bytes for r in got) == sum(len(t or "") for _, t in rows)
    held, prefixes = collections.Counter(), collections.Counter()
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.lpad(F.conv(sharding.key_hash(F.col("doc_id")).cast("string"), 10, 2), 60, "0").alias("h")).collect()}
    for r in got:
        held[r.shard, r.page] += r.row_bytes
        assert hashes[r.doc_id].startswith(r.shard) and len(r.shard) == r.depth
        for d in range(61):
            prefixes[hashes[r.doc_id][:d]] += r.row_bytes
    biggest = {(r.shard, r.page): r.row_bytes for r in got if r.row_bytes > limit}
    assert all(n <= limit or biggest.get(key) == n for key, n in held.items())
    for r in got:
        fits = [d for d in range(61) if prefixes[hashes[r.doc_id][:d]] <= limit]
        assert r.depth == (fits[0] if fits else 60)
    assert sharding.assign_shards(frame(spark, [])).count() == 0


def test_quotations_become_replies(spark):
    rows = [
        (1, 0, "user", "Hello there my friend\n\nHow are you doing today?"),
        (1, 1, "user", "> How are   you DOING today?\nFine, thank you very much"),
        (1, 2, "user", ">> How are you doing today?\n> Fine, thank you very much\nGood to hear that"),
        (1, 3, "user", "A new matter altogether"),
        (1, 4, "user", "> hello there my friend\n> \n> How are you doing today?\nLate answer to the first"),
        (1, 5, "user", "> nobody ever said this\nWell then"), (1, 6, None, None), (2, 0, "user", "> Good to hear that\nother conversation"),
        (1, 3, "user", "A new matter altogether"), (None, None, "user", "> A new matter altogether"), (1, 7, "user", "> Late answer to the first\r\n> Late answer to the first\nself"),
    ]
    messages = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    got = {(r.conv_id, r.turn): r for r in quotation_links.link_quotations(messages).collect()}
    assert len(got) == 10
    assert {k[1]: (r.reply_to, r.thread, r.depth) for k, r in got.items() if k[0] == 1} == {
        0: (None, 0, 0), 1: (0, 0, 1), 2: (1, 0, 2), 3: (None, 3, 0), 4: (0, 0, 1), 5: (None, 5, 0), 6: (None, 6, 0), 7: (4, 0, 2),
    }
    assert got[1, 2].text == "Good to hear that" and got[1, 6].text is None and got[2, 0].reply_to is None
    parts = quotation_links.conversations(messages).where("conv_id = 1").collect()
    assert [m.turn for m in parts[0].messages] == [0, 1, 2, 4, 7, 3, 5, 6] and parts[0].n_links == 4
    assert quotation_links.conversations(messages.limit(0)).count() == 0


def test_written_tables_survive_and_go(spark, tmp_path):
    table = written(spark.range(5))
    assert table.count() == 5


def test_length_bands_lose_no_similar_lines():
    for longer in range(1, 3000):
        fewest = longer - int(longer * round(1 - line_dedup.SIMILAR, 6) + 1e-9)
        for n in range(fewest, longer):
            assert n >= line_dedup.FEWEST_WORDS
            assert longer.bit_length() in (n.bit_length(), (n + n // 9).bit_length())


def test_parity_sketches_of_lines_lose_no_similar_lines(spark):
    """A passage in many different lines, with edits near the limit: the same groups as by all pairs."""
    rng = random.Random(5)
    passage, few, fewer = sentence(rng, 60).split(), sentence(rng, 30).split(), sentence(rng, 9).split()
    lines = []
    for i in range(60):
        own = rng.choices(few, k=rng.randrange(3, 12))
        line = own + passage
        for _ in range(rng.randrange(4)):
            line[rng.randrange(len(line))] = rng.choice(fewer)
        lines.append(" ".join(line))
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    batch = pa.RecordBatch.from_arrays([pa.array(lines)], names=["text"])
    coded = next(line_dedup.line_codes(line_dedup.SKETCH_LONGS)(iter([batch]))).to_pylist()

    def edits(a: str, b: str) -> int:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    group = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            a, b = coded[i]["codes"], coded[j]["codes"]
            if edits(a, b) <= int(max(len(a), len(b)) * (1 - line_dedup.SIMILAR) + 1e-9):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
                parts = line_dedup.sketch_parts(line_dedup.SKETCH_LONGS)
                apart = sum(((coded[i][p] ^ coded[j][p]) & (2**64 - 1)).bit_count() for p in parts)
                assert apart + abs(len(a) - len(b)) <= 2 * edits(a, b)
    assert 1 < len(set(group)) < len(lines)
    kept = {r.doc_id for r in line_dedup.dedup_lines(docs).where("n_dropped = 0").collect()}
    assert kept == set(group)

def test_line_dedup_finds_all_lines_of_the_stated_similarity(spark):
    """One to n / 9 words changed, dropped or added in lines of 9 to 120 words: the groups of all pairs, whatever their fingerprints."""
    rng = random.Random(11)
    lines = []
    for n in [*range(9, 40), 57, 80, 120]:
        base = sentence(rng, n).split()
        # Half of the lines share a passage, which makes its triples common ones.
        base = lines[0].split()[:3] + base if lines and n % 2 else base
        lines.append(" ".join(base))
        for most in (1, n // 10, n // 9 + 1):
            line = list(base)
            for k in range(most):
                at = rng.randrange(len(line))
                line[at : at + rng.randrange(2)] = ["the"] * rng.randrange(2) if k % 2 else ["new%d" % rng.randrange(9)]
            lines.append(" ".join(line))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    words = [re.sub("[0-9]", "0", x).split() for x in lines]
    linked = {
        (i, j) for i in range(len(words)) for j in range(i)
        if 10 * abs(len(words[i]) - len(words[j])) <= max(len(words[i]), len(words[j]))
        and 10 * edits(words[i], words[j]) <= max(len(words[i]), len(words[j]))
    }
    parsed = line_dedup.Lines(*encoded([x + "\n" for x in lines]))
    prints = parsed.simhashes()
    assert sum(int(prints[i] ^ prints[j]).bit_count() > 3 for i, j in linked) > len(linked) // 2
    for common in (np.zeros(0, np.uint64), np.unique(parsed.grams(parsed.senders())[0])[::2]):
        senders = parsed.senders()
        grams, owner = line_dedup.sent(parsed, senders, common)
        sets = {int(i): set(grams[owner == k].tolist()) for k, i in enumerate(senders)}
        assert all(sets[i] & sets[j] for i, j in linked if i in sets and j in sets and words[i] != words[j])
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(5)
    least = smallest_reachable(range(len(lines)), lambda i, j: (max(i, j), min(i, j)) in linked)
    kept = {r.doc_id for r in line_dedup.dedup_lines(docs).where("n_dropped = 0").collect()}
    assert kept == {k for k in range(len(lines)) if least[k] == k}


def test_simhash_blocks_alone_meet_nearly_all_similar_lines():
    """Recall of the first source against all pairs of similar lines of the test documents."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text")
    found = {}
    for _, _, data, offsets in slices(texts):
        lines = line_dedup.Lines(data, offsets)
        senders = lines.senders()
        keys, owner = line_dedup.blocks_of(lines, senders)
        for k, line in enumerate(senders.tolist()):
            words = tuple(lines.hashes[lines.bounds[line] : lines.bounds[line + 1]].tolist())
            if words not in found:
                found[words] = set(keys[owner == k].tolist())
    holders = collections.defaultdict(set)  # similar lines share a triple
    for words in found:
        for gram in zip(words, words[1:], words[2:]):
            holders[gram].add(words)
    pairs = {(a, b) for group in holders.values() for a in group for b in group if a < b and 10 * abs(len(a) - len(b)) <= max(len(a), len(b))}

    def similar(a, b):
        most = max(len(a), len(b)) // 10
        if len(collections.Counter(a) - collections.Counter(b)) > most:
            return False
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1] <= most

    near = [(a, b) for a, b in pairs if similar(a, b)]
    met = sum(bool(found[a] & found[b]) for a, b in near)
    assert len(near) > 250 and met >= 0.95 * len(near)


def test_equal_lines_are_told_by_two_hashes():
    lines = line_dedup.Lines(*encoded(["a b c\n", "a c b\n", "a b\n", "A, b c"]))
    assert lines.checks()[0] == lines.checks()[3] and len(set(lines.checks().tolist())) == 3
    assert not set(lines.checks().tolist()) & set(lines.keys().tolist())


def test_lines_always_have_enough_triples_free_of_overlaps():
    for n in range(line_dedup.FEWEST_WORDS, 400):
        assert -(-(n - line_dedup.GRAM + 1) // (2 * line_dedup.GRAM - 1)) > n // 9


def test_votes_equal_plain_cosines_and_ties_go_to_the_first():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 4, (200, 40)).astype(np.float32)
    got = quality_classifier.first_of_most(values, 15)
    for row, places in zip(values, got, strict=True):
        assert places.tolist() == sorted(sorted(range(40), key=lambda k: (-row[k], k))[:15])
    axes = rng.standard_normal((quality_classifier.DIMS, 8)).astype(np.float32)
    known = quality_classifier.to_unit(rng.standard_normal((40, 8)).astype(np.float32))
    labels, idf = rng.integers(0, 2, 40), np.ones(quality_classifier.DIMS)
    counts = rng.integers(0, 3, (5, quality_classifier.DIMS)).astype(np.float64)
    scores = quality_classifier.Voter(idf, axes, known, labels).scores(counts)
    for row, score in zip(quality_classifier.to_unit(quality_classifier.weighted(counts, idf) @ axes), scores, strict=True):
        cosines = [float(np.dot(row, x)) for x in known]
        nearest = sorted(range(40), key=lambda k: (-cosines[k], k))[:15]
        weight = [max(cosines[k], 0.0) ** quality_classifier.POWER for k in nearest]
        assert score == pytest.approx(sum(w * labels[k] for w, k in zip(weight, nearest, strict=True)) / sum(weight), abs=1e-4)


def test_sample_is_bounded_and_needs_no_order_of_rows(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "SAMPLE", 10)
    docs = frame(spark, [(k, f"text {k}") for k in range(50)] + [(7, "text 7")] * 30 + [(3, "other"), (None, "x"), (60, None)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(70)], "doc_id long, label int")
    got = [sorted(map(tuple, quality_classifier.sampled(docs.repartition(n), labels).collect())) for n in (1, 5)]
    assert got[0] == got[1] and len(got[0]) == 10


def test_worker_tables_are_made_once(spark):
    """Tasks reuse what their process has imported: its memory does not grow from task to task."""
    import resource

    def run(batches):
        import os

        for batch in batches:
            for _ in line_dedup.describe_lines(iter([batch])):
                pass
            size = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([size])], names=["pid", "kb"])

    rows = spark.range(16).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("version"), F.lit("a b c\nd e").alias("text")).coalesce(1)
    found = collections.defaultdict(list)
    for _ in range(100):
        for r in map_arrow(rows, run, "pid long, kb long").collect():
            found[r.pid].append(r.kb)
    longest = max(found.values(), key=len)
    assert longest[-1] - longest[len(longest) // 5] < 20_000
