import random

import pytest
from pyspark.sql import functions as F

from clinweave.llm import leaks, spans, tokens
from clinweave.plans import skew

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(rng, n):
    out = ""
    while len(out) < n:
        out += " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(rng.randrange(3, 30))) + rng.choice([". ", "? ", "\n", "; ", ".\r\n"])
    return out[:n]


def brute_spans(rows, k):
    own = {}
    for i, t in rows:
        for p in range(len(t or "") - k + 1):
            own.setdefault(t[p : p + k], set()).add(i)
    out = set()
    for i, t in rows:
        hit = [p for p in range(len(t or "") - k + 1) if len(own[t[p : p + k]]) > 1]
        run = None
        for p in hit:
            if run and p <= run[1]:
                run[1] = p + k
            else:
                if run:
                    out.add((i, *run))
                run = [p, p + k]
        if run:
            out.add((i, *run))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_spans_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_HOT_ROWS", 40)
    rng = random.Random(seed)
    pool = [prose(rng, rng.randrange(150, 500)) for _ in range(6)] + ["字" * 260 + prose(rng, 100), "x" * 700, "🙂" * 210]
    rows = []
    for i in range(60):
        text = prose(rng, rng.randrange(0, 400))
        for _ in range(rng.randrange(3)):
            p = rng.choice(pool)
            a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            text += rng.choice([p, p[a:b]]) + prose(rng, rng.randrange(0, 200))
        rows.append((i, text))
    rows += [(100, None), (101, ""), (102, "short"), (103, rows[0][1]), (104, rows[0][1]), (105, "y" * 200), (106, "y" * 201), (107, "z" * 450)]
    df = spark.createDataFrame([*rows, (None, rows[5][1] + pool[0])], "doc_id long, text string").withColumns({"h": F.lit(1), "len": F.lit("clash")}).repartition(4)
    assert {tuple(r) for r in spans.shared_spans(df).collect()} == brute_spans(rows, 200)
    share = {r.doc_id: r for r in spans.shared_share(df.filter("doc_id is not null")).collect()}
    assert len(share) == len(rows) and share[100].n_chars == 0 and share[105].shared_fraction == 1.0


@pytest.mark.parametrize("least", [103, 131, 250])
def test_spans_of_other_lengths(spark, least):
    rng = random.Random(least)
    pool = [prose(rng, rng.randrange(90, 400)) for _ in range(5)]
    rows = [(i, prose(rng, rng.randrange(0, 200)) + rng.choice(pool)[rng.randrange(60) :] + prose(rng, rng.randrange(0, 200))) for i in range(40)]
    assert {tuple(r) for r in spans.shared_spans(spark.createDataFrame(rows, "doc_id long, text string"), least).collect()} == brute_spans(rows, least)


def test_a_footer_in_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_HOT_ROWS", 10)
    rng = random.Random(8)
    footer = prose(rng, 230)
    rows = [(i, prose(rng, 300) + (footer if i % 3 == 0 else "")) for i in range(90)]
    assert {tuple(r) for r in spans.shared_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute_spans(rows, 200)


def test_spans_of_nothing(spark):
    assert spans.shared_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sentences_of_later_runs_are_removed(spark):
    rng = random.Random(4)
    own = [prose(rng, 150) + ". " for _ in range(6)]
    shared = "First sentence of a passage that stands in several documents. " * 2 + "And a third one that closes the passage with quite some more words in it. Done. "
    rows = [(1, own[0] + shared + own[1]), (2, own[2] + shared + own[3]), (3, shared + own[4]), (4, own[5]), (5, None), (6, "short"), (7, shared + own[5] + shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("run", F.lit(1))
    for i, a, b in [tuple(r) for r in spans.removable(df).collect()]:
        assert dict(rows)[i][a:b] in shared + own[5] + shared and i != 1
    kept = {r.doc_id: r.text for r in spans.without_repeats(df).collect()}
    assert {i: kept[i] for i in (1, 4, 5, 6)} == {i: t for i, t in rows if i in (1, 4, 5, 6)}
    assert kept[2] == own[2] + own[3] and kept[3] == own[4]
    assert "First sentence" not in kept[7]
    assert spans.removable(df.limit(0)).count() == 0


ODD = ["", None, " ", "\n\n ", "a  b   c", "don't we'll I'M 's", "<|endoftext|> x", "naïve café 日本語 🙂👍🏽", "x y z\u0085w", "１２３ ²³ Ⅷ", "é ﬁ", "​﻿", "tab\tand\r\nline", "͸\U000e0fff odd", "ab" * 3000, "1234567890" * 50, "\x1c\x1d words"]


@pytest.mark.parametrize("most", [200_000, 3])
def test_ids_equal_the_tokenizer(spark, monkeypatch, most):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "MOST_WORDS", most)
    rng = random.Random(2)
    texts = ODD + [prose(rng, 300) for _ in range(40)] + [" ".join(rng.choice(ODD[4:]) for _ in range(3)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("word", F.lit(0)).repartition(3)
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    expected = {i: own.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    encoded = tokens.encode_corpus(df)
    assert {r.doc_id: r.ids for r in encoded.collect()} == expected
    assert {r.doc_id: r.text for r in tokens.decode_corpus(encoded).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_encoders_are_told_apart_by_content():
    one, other = {b"a": 0, b"b": 1, b"ab": 2}, {b"a": 1, b"b": 0, b"ba": 2}
    coders = [tokens._encoder(t, tokens._content(t)) for t in (one, other)]
    assert [c.encode_ordinary("ab") for c in coders] == [[2], [1, 0]]


def test_encoding_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.encode_corpus(none).count() == 0
    assert [r.ids for r in tokens.encode_corpus(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [[]]


def brute_leaks(rows, items, run):
    import re

    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    out = set()
    grams = {}
    for j, t in items:
        w = words(t)
        for p in range(len(w) - run + 1):
            grams.setdefault(tuple(w[p : p + run]), set()).add(j)
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - run + 1):
            out |= {(i, j) for j in grams.get(tuple(w[p : p + run]), ())}
    return out


@pytest.mark.parametrize("sent", [2_000_000, 0])
def test_leaks_equal_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(leaks, "MOST_SENT_GRAMS", sent)
    monkeypatch.setattr(leaks, "MOST_SENT_TEXT", sent)
    monkeypatch.setattr(skew, "LEAST_HOT_ROWS", 15)
    rng = random.Random(5)
    items = [(j, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(3, 30)))) for j in range(25)] + [(90, None), (91, ""), (92, "one " * 20)]
    rows = []
    for i in range(120):
        w = [rng.choice(WORDS) for _ in range(rng.randrange(0, 60))]
        item = (rng.choice(items[:25])[1]).split()
        a = rng.randrange(len(item))
        part = item[a : a + rng.choice([5, 11, 12, 13, 30])]
        at = rng.randrange(len(w) + 1)
        rows.append((i, rng.choice([" ", ", ", " *\n", "_-_"]).join(w[:at] + [x.upper() if rng.random() < 0.3 else x for x in part] + w[at:])))
    rows += [(500, None), (501, ""), (502, "ONE one. one " * 12), (503, items[3][1] + " " + items[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"gram": F.lit(1), "place": F.lit(2)}).repartition(4)
    tests = spark.createDataFrame(items, "item_id long, item_text string").withColumn("text", F.lit("clash"))
    assert {tuple(r) for r in leaks.leaked_items(df, tests).collect()} == brute_leaks(rows, items, 12)
    report = {r.item_id: r.docs_with_run for r in leaks.leak_report(df, tests).collect()}
    assert sum(report.values()) == len(brute_leaks(rows, items, 12))
    assert leaks.leaked_items(df.limit(0), tests).count() == 0 and leaks.leaked_items(df, tests.limit(0)).count() == 0


def test_alignment_scores_an_edited_copy():
    import numpy as np

    item = np.arange(10, 20, dtype=np.uint64)
    text = np.concatenate([np.arange(100, 105), np.arange(10, 14), [999], np.arange(15, 20), np.arange(200, 204)]).astype(np.uint64)
    score, start, end, longest = leaks.align(item[None], text[None])
    assert (score[0], start[0], end[0], longest[0]) == (9 * leaks.MATCH + leaks.MISMATCH, 5, 15, 5)
    score, start, end, longest = leaks.align(item[None], np.delete(item, 4)[None])
    assert (score[0], longest[0]) == (9 * leaks.MATCH + leaks.GAP, 5)


def test_recall_of_edited_copies_against_full_alignment(spark):
    """Copies with one word in three to twelve changed, dropped or added, against the alignment of every pair; README states the figure."""
    import numpy as np

    from clinweave.llm.words import WordHasher

    rng = random.Random(12)
    items = [(j, " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(rng.randrange(20, 60)))) for j in range(30)]
    rows = []
    for i in range(300):
        words, step = [], rng.choice([3, 4, 5, 6, 8, 12])
        for w in rng.choice(items)[1].split():
            words += [w] if rng.randrange(step) else rng.choice([[], ["other"], [w, "more"]])
        rows.append((i, " ".join(["before"] * rng.randrange(20) + words + ["after"] * rng.randrange(20))))
    hasher = WordHasher()
    full = set()
    for j, item in items:
        a = hasher([item])[0]
        for i, text in rows:
            score = leaks.align(a[None], hasher([text])[0][None])[0][0]
            if score >= 0.5 * leaks.MATCH * len(a):
                full.add((i, j))
    df, tests = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string")
    got = {(r.doc_id, r.item_id): r.share for r in leaks.alignments(df, tests).collect()}
    found = {k for k, share in got.items() if share >= 0.5}
    print(f"recall {len(found & full) / len(full):.3f} of {len(full)}")
    assert len(full) > 100 and found <= full and len(found & full) >= 0.9 * len(full)


def test_report_counts_edited_copies(spark):
    items = [[f"{name}{i}" for i in range(40)] for name in ("alpha", "beta")]
    copies = [["changed" if i % 8 == 4 else w for i, w in enumerate(item)] for item in items]
    rows = [(1, "before " + " ".join(items[0])), (2, " ".join(copies[0]) + " after"), (3, "Before, " + ", ".join(copies[1])), (4, "alpha0 alpha1 alpha2 alpha3"), (5, " ".join(items[1][:6]))]
    tests = spark.createDataFrame([(j, " ".join(item)) for j, item in enumerate(items)], "item_id long, item_text string")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    report = {r.item_id: (r.docs_with_run, r.docs_with_copy, r.best_share) for r in leaks.leak_report(df, tests).collect()}
    assert report == {0: (1, 2, 1.0), 1: (0, 1, (35 * leaks.MATCH + 5 * leaks.MISMATCH) / (40 * leaks.MATCH))}
    assert {tuple(r) for r in leaks.leaked_items(df, tests).collect()} == {(1, 0)}
