"""Quotations planted in generated conversations, against a plain reading of every message."""

import random
import re

from tidelake.llm import quotation_links

SCHEMA = "conv_id long, turn long, role string, text string, thread string"


def squeezed(text):
    return re.sub(r"\s+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).strip(" ")


def units(blocks):
    whole = [squeezed(b) for b in blocks]
    return {u for u in whole + [s for b in whole for s in re.split("(?<=[.!?]) ", b)] if u}


def parse(text):
    """Own text, and (level, lines) of every quoted run."""
    runs = []
    for line in text.split("\n"):
        marks = re.match(r"^([ \t]*>)+", line)
        level = marks[0].count(">") if marks else 0
        body = line[marks.end() :].strip(" ") if marks else line
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(body)
    own = "\n".join(line for level, lines in runs if not level for line in lines).strip("\n")
    return own, [run for run in runs if run[0]]


def plain_links(messages):
    """{(conv_id, turn): reply_to} by looking through all earlier messages."""
    parsed = {(c, t): parse(text) for c, t, _, text, _ in messages}
    holds = {}
    for (c, t), (own, _) in sorted(parsed.items()):
        for unit in units([own, *re.split(r"\n[ \t]*\n", own), *own.split("\n")]):
            holds.setdefault((c, unit), t)
    links = {}
    for (c, t), (_, runs) in parsed.items():
        found = []
        for level, lines in runs:
            for unit in units(["\n".join(lines), *lines]):
                source = holds.get((c, unit))
                if source is not None and source < t:
                    found.append((-level, len(unit), source))
        if found:
            links[c, t] = max(found)[2]
    return links


def planted(n_conversations, n_turns, seed):
    """Messages that quote earlier ones whole, by paragraph, line or sentence, nested up to three levels."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    rows, meant = [], {}
    for c in range(n_conversations):
        own, full = [], []
        for t in range(n_turns):
            paragraphs = []
            for k in range(rng.randint(1, 3)):
                lines = [" ".join(" ".join(rng.choices(words, k=rng.randint(4, 9))).capitalize() + rng.choice(".!?") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 2))]
                paragraphs.append("\n".join(lines))
            if rng.random() < 0.3:
                paragraphs.append(f"Why {rng.choice(words)}{c}x{t}?")
            mine = "\n\n".join(paragraphs)
            text = mine
            if t and rng.random() < 0.8:
                source = rng.randrange(t)
                kind = rng.choice(["full", "whole", "paragraph", "line", "sentence", "short"])
                told = own[source]
                if kind == "full":
                    told = full[source]
                elif kind == "paragraph":
                    told = rng.choice(told.split("\n\n"))
                elif kind == "line":
                    told = rng.choice([x for x in told.split("\n") if x])
                elif kind == "sentence":
                    told = rng.choice(re.split(r"(?<=[.!?])\s+", told))
                elif kind == "short":
                    told = told.split("\n")[-1]
                text = "\n".join("> " + line for line in told.split("\n")) + "\n" + mine
                if rng.random() < 0.1:
                    text = text.replace("\n", "\r\n").upper()
                meant[c, t] = source
            own.append(mine)
            full.append(text.replace("\r\n", "\n") if text.count("> ") < 60 else mine)
            rows.append((c, t, "user", text.replace("\r\n", "\n"), "clash"))
    rng.shuffle(rows)
    return rows, meant


def test_planted_quotations_of_ten_thousand_messages_are_linked(spark):
    rows, meant = planted(250, 42, 8)
    got = {(r.conv_id, r.turn): r.reply_to for r in quotation_links.link_quotations(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()}
    want = plain_links(rows)
    assert len(got) == len(rows) and len(meant) > 7000
    assert {k: v for k, v in got.items() if v is not None} == want
    assert sum(got[k] == source for k, source in meant.items()) > 0.99 * len(meant)


def test_short_lines_and_single_sentences_are_linked(spark):
    rows = [
        (1, 0, "a", "Let us meet at noon.\nWhy not? I think it suits all of us. Bring cake.", None),
        (1, 1, "b", "Another matter.\nOk", None),
        (1, 2, "c", "> Why not?\nBecause.", None),
        (1, 3, "d", "> I think it suits all of us.\nFine.", None),
        (1, 4, "e", ">> Ok\n> Because.\nHm.", None),
        (2, 5, "f", "> Ok\nother conversation", None),
    ]
    got = {(r.conv_id, r.turn): (r.reply_to, r.thread, r.depth) for r in quotation_links.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, 0): (None, 0, 0), (1, 1): (None, 1, 0), (1, 2): (0, 0, 1), (1, 3): (0, 0, 1), (1, 4): (2, 0, 2), (2, 5): (None, 5, 0)}


def test_parts_stay_small_for_one_turn_and_rows_without_keys(spark, monkeypatch):
    monkeypatch.setattr(quotation_links, "PART_MESSAGES", 20)
    rows = [(1, 3, "a", f"text {k}", None) for k in range(300)] + [(1, 4, "b", "> text 7\nanswer", None)]
    rows += [(None, None, "c", f"lost {k}", None) for k in range(300)] + [(2, None, "d", f"none {k}", None) for k in range(50)]
    rows += [(5, t, "e", f"turn {t}", None) for t in range(10)]
    parts = quotation_links.conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(p.n_messages for p in parts) < 60
    assert sum(p.n_messages for p in parts) == len(rows) and sum(p.n_links for p in parts) == 1
    told = sorted((p for p in parts if p.conv_id == 1), key=lambda p: (p.thread_block, p.turn_block, p.part_turn, p.part))
    assert told[-1].messages[-1].reply_to == 3 and [len(p.messages) for p in parts if p.conv_id == 5] == [10]
    assert quotation_links.conversations(spark.createDataFrame([], SCHEMA)).count() == 0
