import datetime as dt
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinweave.llm import overlap, pairs, pii
from clinweave.plans import skew

NAMES = [f"{a}{b}" for a in ("Bra", "Ste", "Vo", "Glu", "Mi") for b in ("dira", "kolu", "nepi", "zuva")]


def question(rng):
    a, b = rng.sample(NAMES, 2)
    return rng.choice(
        [
            f"Which early signs should make people think of {a}-{b} fever?",
            f"My sister was told last spring that it is {a} {b} palsy and now takes {rng.choice(NAMES).lower()}ine for cold hands, is a long walk still safe after {rng.randrange(40)} days of rest at home?",
            f"How would you explain {a}-{b} anemia to someone newly diagnosed?",
        ]
    )


def edited(rng, q, n):
    w = q.split()
    for _ in range(n):
        i = rng.randrange(len(w) - 1)
        kind = rng.randrange(4)
        if kind == 0:
            w[i] = "maybe"
        elif kind == 1:
            w.insert(i, "please")
        elif kind == 2:
            del w[i]
        else:
            w[i], w[i + 1] = w[i + 1], w[i]
    return " ".join(w)


HEADS = frozenset("fever palsy anemia".split())


def brute_pairs(rows, home):
    import re

    def words(t):
        return re.findall(r"[^\W_]+", overlap.plain(t).lower())

    out = set()
    for i, x in rows:
        for j, y in rows:
            if home.get(i) == "train" and home.get(j) in ("validation", "test") and x and y:
                a, b = words(x), words(y)
                most = max(len(a), len(b)) // 10
                if a and b and ("".join(a) == "".join(b) or (overlap.word_distance(a, b, most) <= most and not overlap.other_conditions(a, b, HEADS))):
                    out.add((min(i, j), max(i, j)))
    return out


@pytest.mark.parametrize("often", [32, 1])
def test_pairs_equal_brute_force(spark, monkeypatch, often):
    monkeypatch.setattr(overlap, "OFTEN", often)
    monkeypatch.setattr(overlap, "VERY_OFTEN", 4 * often)
    monkeypatch.setattr(skew, "LEAST_HOT_ROWS", 50)
    rng = random.Random(6)
    rows = []
    for i in range(0, 300, 3):
        q = question(rng)
        rows += [(i, q), (i + 1, edited(rng, q, rng.randrange(4))), (i + 2, rng.choice([q.upper(), q.replace("-", ""), f"“{q} ”", question(rng)]))]
    rows += [(900, None), (901, ""), (902, "?"), (903, "Ｗhat"), (904, "what"), (905, "what?"), (906, rows[0][1])]
    splits = [(i, rng.choice(["train", "train", "validation", " TEST "]), dt.datetime(2024, 1, 2)) for i, _ in rows if i != 906]
    old = [(i, "test", dt.datetime(2024, 1, 1)) for i, _ in rows[:50]] + splits[:20] + [(None, "test", None), (5, None, None)]
    home = {i: s.strip().lower() for i, s, _ in splits}
    records = spark.createDataFrame([(i, q, ("c",)) for i, q in rows], "row_id long, question string, source struct<collection:string>").withColumns({"words": F.lit(1), "n": F.lit(2)})
    focus = F.when(F.col("row_id") % 7 == 0, None).otherwise(F.concat(F.lit("Foo-Bar "), F.element_at(F.array(*[F.lit(x) for x in ("fever", "palsy, ann@site.example", "anemia (x)")]), (F.col("row_id") % 3 + 1).cast("int"))))
    records = records.withColumn("focus", focus)
    assert {r["head"] for r in overlap.condition_heads(records).collect()} == HEADS
    table = spark.createDataFrame(splits + old, "row_id long, split_name string, assigned_at timestamp")
    monkeypatch.setattr(overlap, "MOST_SENT_HEADS", 2 if often == 1 else 100)
    got = [tuple(r) for r in overlap.cross_split_pairs(records, table).collect()]
    full = brute_pairs(rows, home)
    print(f"recall {len(full & set(got)) / len(full):.4f} of {len(full)}")
    assert len(got) == len(set(got)) and set(got) <= full and len(full & set(got)) >= 0.99 * len(full)
    classes = {r.row_id: r for r in overlap.row_classes(records, table).collect()}
    assert {i: r.n_links for i, r in classes.items() if r.n_links} == dict(Counter(i for pair in got for i in pair))
    assert all(classes[r.class_id].class_id == r.class_id <= i for i, r in classes.items())
    report = overlap.overlap_report(records, table).collect()
    assert sum(r.n_rows for r in report) == sum(s != "train" for s in home.values())
    fractions = {r.row_id: r.overlap for r in overlap.overlap_fractions(records, table).collect()}
    assert all(0 <= x <= 1 for x in fractions.values())
    exact = {i for i, q in rows if q and home.get(i) not in (None, "train") and any(home.get(j) == "train" and q == y for j, y in rows)}
    assert all(fractions[i] == 1.0 for i in exact if pairs.WORD.search(dict(rows)[i]))
    assert overlap.cross_split_pairs(records.limit(0), table).count() == 0


def test_hot_questions_are_paired_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_HOT_ROWS", 8)
    rows = [(i, "What are the signs of Foo fever?" if i % 3 else f"Is number {i} of the list inherited?", i % 5 == 0) for i in range(120)]
    records = spark.createDataFrame([(i, q, None, ("c",)) for i, q, _ in rows], "row_id long, question string, focus string, source struct<collection:string>")
    table = spark.createDataFrame([(i, "test" if held else "train", dt.datetime(2024, 1, 1)) for i, _, held in rows], "row_id long, split_name string, assigned_at timestamp")
    got = [tuple(r) for r in overlap.cross_split_pairs(records, table).collect()]
    hot = [i for i, q, _ in rows if i % 3]
    expected = {(min(i, j), max(i, j)) for i in hot for j in hot if rows[j][2] and not rows[i][2]}
    assert len(got) == len(set(got)) and set(got) == expected


@pytest.mark.parametrize(("a", "b", "most", "d"), [("abc", "abc", 1, 0), ("abcd", "abdc", 1, 1), ("abc", "xbc", 1, 1), ("abc", "bc", 1, 1), ("abcd", "badc", 1, 2), ("", "ab", 1, 2), ("ab", "", 2, 2)])
def test_word_distance(a, b, most, d):
    assert overlap.word_distance(list(a), list(b), most) == d


def test_every_reachable_text_shares_a_key():
    rng = random.Random(3)
    met = total = 0
    for _ in range(3000):
        n = rng.randrange(9, 45)
        a = [rng.randrange(60) for _ in range(n)]
        b = list(a)
        for _ in range(rng.randrange(max(len(a), 10) // 10 + 1)):
            i = rng.randrange(len(b) - 1)
            kind = rng.randrange(3)
            b[i : i + 1] = [[rng.randrange(100, 200)], [b[i], rng.randrange(100, 200)], [b[i + 1], b[i]]][kind]
            if kind == 2:
                del b[i + 2]
        if overlap.most_edits(n):
            keys = []
            for w in (a, b):
                tokens = overlap.fine_chunks(np.array(w, np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.array([0, len(w)]))[1].tolist()
                keys.append({tuple(k) for k in overlap.join_keys(sorted((t % 50, t) for t in tokens), len(w))})
            total += 1
            met += bool(keys[0] & keys[1])
    print(f"{met} of {total} texts within reach share a key")
    assert met >= 0.995 * total


def test_other_conditions():
    def differ(a, b):
        return overlap.other_conditions(a.lower().split(), b.lower().split(), HEADS | {"asthma", "eczema"})

    assert differ("signs of asthma", "signs of eczema")
    assert differ("signs of foo fever", "signs of bar fever") and differ("foo bar fever", "foo bar palsy")
    assert not differ("foo bar fever", "foo bar please fever") and not differ("foo fever", "fo fever") and not differ("foo bar", "foo bar fever")


GOOD = [
    "The first signs are fever and cough. Call the clinic if the cough lasts.",
    "Signs to watch for: dry eyes; joint stiffness",
    "It is inherited (Reviewed together with the Harrow Fen Trust)",
    "- Rest helps\n- Water helps",
    "In Spanish it is known as “fiebre de Foo”.",
    "**Rest and water help.**",
    "<p>Rest &amp; water help.</p>",
    "We are sorry to hear about the cough, and the advice below should help with rest.",
]
SENTENCES = [s + "." for s in ("Rest and water help", "Signs to watch for: dry eyes; joint stiffness", "It is inherited", "Rest helps", "Water helps", "The first signs are fever and cough", "Doctors advise rest and plenty of water")] * 30
MODELS = pairs.Models(pairs.Tails.fit(SENTENCES), pairs.Languages.fit([]))
Q = "What are the first signs of Foo fever and how is it treated?"


@pytest.mark.parametrize("answer", GOOD)
def test_sound_answers(answer):
    assert pairs.defect_of(Q, answer, MODELS) is None


@pytest.mark.parametrize(
    ("answer", "kind"),
    [
        *[(a, "empty") for a in (None, "", " \n", "N/A", "n/a.", "<p></p>", "&nbsp;", "[no answer]", "TBD", "null", "-", "​", "No answer provided", "{}", "(blank)", "Answer:")],
        *[(a, "echo") for a in (Q, Q.upper(), f"You asked: {Q}", f"{Q} {Q}", Q.replace(" ", "  "), f"“{Q}”", Q.replace("?", ""))],
        *[
            (a, "refusal")
            for a in (
                "I'm sorry, but I can't provide medical advice on Foo fever.", "As an automated assistant, we do not give information of this kind.", "I must decline to respond here.",
                "this request falls outside what i am allowed to answer", "No guidance about Foo can be given by this service.", "I’d rather not comment on Foo fever. Try elsewhere.", "Lo siento, no puedo responder a esta pregunta.",
            )
        ],
        *[(a, "other_language") for a in ("Der Arzt bestätigt die Krankheit nach einer Untersuchung und nicht durch einen Test.", "Nie ma leku na to, ale odpoczynek jest dobry i nie szkodzi.", "Это болезнь глаз.", "Las personas con la enfermedad notan tos y fiebre en el día.")],
        *[(a, "truncated") for a in ("Rest helps. The first signs are…", "Rest helps. Doctors advise (for example", "Rest helps. In a [continued", "Rest helps. Rest and wat", "- Rest helps\n- ", "Rest helps. ```\ncode", "<p>Rest helps. <b>Wat", "Rest helps, and", "Rest helps. It is the so-called “")],
    ],
)
def test_defects(answer, kind):
    assert pairs.defect_of(Q, answer, MODELS) == kind


def test_echoes_and_blanks_of_any_length():
    assert pairs.defect_of("什么是红斑狼疮？", "什么是红斑狼疮", MODELS) == "echo" and pairs.defect_of("Foo fever?", "foo fever", MODELS) == "echo"
    assert pairs.defect_of(Q, "- " * 60, MODELS) == "empty" and pairs.defect_of(Q, "." * 200, MODELS) == "empty"
    assert not pairs.is_echo([], ["rest"]) and not pairs.is_echo(["fever"], ["rest"])


def test_same_other_language_and_exchanged_fields_are_sound():
    german = ("Welche Beschwerden macht die Krankheit und wie lange dauern sie?", "Die Krankheit dauert meist lange und ist nicht leicht zu heilen.")
    assert pairs.defect_of(*german, MODELS) is None
    assert pairs.defect_of(GOOD[0], Q, MODELS) is None


def test_parser():
    assert pairs.left_open("a (b [c] d") == ["("] and pairs.left_open("(a) ] b") == [] and pairs.left_open("```x ( ```") == []
    assert pairs.left_open("<p>a<br>b") == ["<p"] and pairs.left_open('5" wide') == [] and pairs.left_open("say “x") == ["“"]
    assert pairs.tiles("a b c d".split(), "x a b c y".split()) == (3, 3)
    assert pairs.tiles("a b c d".split(), "a b c d a b c d b c".split()) == (10, 4) and pairs.tiles("a b c".split(), "b c b".split()) == (2, 2)
    for text, found in (("1. a\n2. b\n3.", ["item"]), ("There are three steps:\n- Rest\n- Water", ["list"]), ("Buy 1) a mask, 2)", ["item"]), ("- a\n- b", []), ("In 30. It is (2) good 3.", []), ("Two signs: 1. fever 2. cough", [])):
        assert pairs.left_open(text) == found, text


def test_defective_pairs_in_spark(spark):
    rows = [(i, Q, a, "en", "c") for i, a in enumerate([*GOOD, None, Q, "I must decline to respond here."])] + [(50, None, None, None, "d"), (51, None, GOOD[0], None, "d")]
    df = spark.createDataFrame([(*r[:4], (r[4],)) for r in rows], "row_id long, question string, answer string, language string, source struct<collection:string>").withColumn("k", F.lit(1))
    got = {r.row_id: r.defect_type for r in pairs.defective_pairs(df, MODELS).collect()}
    assert got == {8: "empty", 9: "echo", 10: "refusal", 50: "empty"}
    assert pairs.defective_pairs(df).filter("row_id in (8, 9, 10)").count() == 3
    assert pairs.defective_pairs(df.limit(0)).count() == 0 and pairs.defect_counts(df, MODELS).count() == 4


HELD_OUT = {
    "empty": ["no response", "Not applicable.", "<div> </div>", "...", "To be completed", "TODO", "No information available", "Answer not provided.", "(none)", "Pending", "n.a.", "???"],
    "refusal": [
        "I am not able to answer this question.", "We cannot offer advice on individual cases.", "Sorry, that is something I can't help with.", "Unfortunately I am unable to respond to medical questions.",
        "This assistant is not permitted to discuss treatment.", "As an AI language model, I cannot diagnose Foo fever.", "I would prefer not to answer.", "It would be inappropriate for us to comment on this.",
        "Je ne peux pas répondre à cette question.", "Ich kann diese Frage leider nicht beantworten.", "Your request has been declined.", "No comment.",
    ],
    "echo": [f"The question is: {Q}", f"Q: {Q}", Q.lower().rstrip("?"), f"Re: {Q}", f"{Q}\n\n{Q}", f"> {Q}", f"Good question. {Q}"],
    "truncated": [
        "Rest helps. The doctor will then", "Water helps. Signs are fever (", "The cough lasts because of the", "Three signs matter:\n1. fever\n2. cough", "Rest helps:\n* sleep\n*", "It is inherited. See [the", "Rest and water help. He said “take",
        "Rest helps. ```\nrest: 3", "<ul><li>Rest</li><li>", "The first signs are fever, cough and", "Ask for a test such as", "Rest helps. In most ca",
    ],
    "other_language": [
        "La enfermedad se trata con reposo y agua durante unos días.", "Die Krankheit ist nicht ansteckend und heilt meist von selbst.", "La maladie est rare et les premiers signes sont la fièvre et la toux.", "A doença não tem cura, mas o descanso ajuda a pessoa.",
        "La malattia è rara e i primi segni sono la febbre e la tosse.", "Choroba jest rzadka i nie ma na nią leku.", "これは珍しい病気です。", "Η νόσος είναι σπάνια.",
    ],
    None: [
        "Rest helps. Doctors advise rest (and plenty of water).", "Two signs matter:\n1. fever\n2. cough", "We cannot cure it, but rest and water help most people.", "Doctors do not advise surgery.", "The first signs are fever and cough; call the clinic if the cough lasts.",
        "It is known as Foo fever, or “fever of Foo”.", "No test is needed.", "There is no known cure.", "- fever\n- cough\n- dry eyes", "The answer depends on age: children need rest, adults need water.", "Take 10 mg in the morning.", "Foo fever is not catching.",
        "Not everyone notices a fever, and some people have no signs at all.", "The first signs of Foo fever are cough and fever, and it is treated with rest.", "Rest helps. It is called Krankheit in German.", "We are not sure why it starts. It may be inherited.",
    ],
}


def test_held_out_wordings():
    """Wordings that the rules were not written from: README states the figures."""
    judged = [(kind, pairs.defect_of(Q, answer, MODELS)) for kind, answers in HELD_OUT.items() for answer in answers]
    bad = [(k, g) for k, g in judged if k]
    assert sum(k == g for k, g in bad) >= 0.85 * len(bad)
    found = [(k, g) for k, g in judged if g]
    assert sum(k == g for k, g in found) >= 0.9 * len(found)


FILLER = ["Give 10 mg @ bedtime.", "Serial 4471.25.90 failed the check.", "Between 1998-2004 the rate was 80-25.", "The Lane-Hart scale gave 10 points.", "Go to room 12 on floor 2.", "Patient ID is required at the front desk."]
DETAILS = {
    "email": ["Write to ann.lee@site.example for more.", "E-mail: bo [at] host.example.", "Results go to c_d9 @ mail.test please."],
    "phone": ["Call (264) 555-0192 today.", "Fax or ring +44 7700 900136.", "Our line is 785.555.0126, day and night.", "Tel: 1-949-555-0126 ext. 76.", "Call five five five, zero one seven two."],
    "id_number": ["Please quote SSN 839-51-3243.", "On file: passport number X04056971.", "MRN: AB-057723.", "It lists CPF 776.710.528-76."],
    "address": ["We live at 427 Brilenide Sq., Apt 28, East Quill.", "Send samples to P.O. Box 1046, Feldmoor.", "Home visit at Sotatelistraße 128, Port Ansley.", "We live at 12 Brilenide Steading, Feldmoor."],
    "name": ["Dr. Jessamy Linduleti told us about this.", "Patient name: Noelka Testudendu;", "My name is kestrin pulari.", "Please ask for Pavlina Zosineli at the desk.", "My son Davrin has the same complaint.", "Regards, É. Distafegi."],
}


def pii_rows(rng, n):
    rows, truth = [], set()
    for i in range(n):
        text, kind = [rng.choice(FILLER)], rng.choice([*DETAILS, None, None])
        if kind:
            text.insert(rng.randrange(2), rng.choice(DETAILS[kind]))
            truth.add((i, "answer", kind))
        rows.append((i, "What is Foo-Bar fever?", " ".join(text), None))
    return rows, truth


def test_details_are_found_and_replaced(spark):
    rows, truth = pii_rows(random.Random(1), 400)
    df = spark.createDataFrame(rows, "row_id long, question string, answer string, focus string").withColumns({"start": F.lit(1), "pii_type": F.lit("clash")})
    spans = pii.accepted_spans(df).cache()
    got = {(r.row_id, r.field_name, r.pii_type) for r in spans.collect()}
    assert len(got & truth) >= 0.98 * len(truth) and len(got & truth) >= 0.98 * len(got)
    clean = {r.row_id: r for r in pii.redact(df).collect()}
    assert len(clean) == 400
    for i, _, answer, _ in rows:
        kinds = {k for j, _, k in got if j == i}
        assert clean[i].focus is None and (clean[i].answer == answer) is (not kinds)
        assert all(pii.PLACEHOLDERS[k] in clean[i].answer for k in kinds)
    assert pii.redaction_report(df, spans).count() == 5


@pytest.mark.parametrize("sent", [200_000, 1])
def test_names_of_the_whole_corpus_are_known(spark, monkeypatch, sent):
    monkeypatch.setattr(pii, "MOST_SENT_NAMES", sent)
    rows = [(i, "What is Foo-Bar fever?", f"Dr. {n} Linduleti told us about this.", None) for i, n in enumerate(["Jessamy", "Jessamy", "Jessamy", "Pavlina", "Pavlina", "Once"])]
    rows += [(10, None, "Lately Pavlina felt tired.", None), (11, None, "Lately Once felt tired.", "Jessamy"), (12, None, "Mail pavlina@site.example or x-Pavlina, Jessamy Test-Name and Pavlina_1.", None)]
    rows += [(i, "Is it inherited?", "Rest and water help.", None) for i in range(100, 45_100)]
    df = spark.createDataFrame(rows, "row_id long, question string, answer string, focus string")
    known, own = pii.gather_gazetteer(df)
    assert set(known.names) == {"Jessamy", "Pavlina"} if sent > 1 else set(known.names) == {"Jessamy"}
    assert own is None if sent > 1 else {r.row_id: r.own for r in own.collect()} == {i: ["Pavlina"] for i in (3, 4, 10, 12)}
    spans = pii.candidate_spans(df, known, own).filter("row_id between 10 and 12 and pii_type = 'name' and votes[2] = 1").collect()
    assert {(r.row_id, r.shown) for r in spans} == {(10, "Pavlina"), (11, "Jessamy"), (12, "Jessamy Test-Name")}


def test_the_classifier_rejects_what_the_votes_alone_would_take():
    """Spans with the same votes, of which short ones come with doubt from elsewhere, are told apart by their features."""
    votes = (1, 0, 1, 0)
    rows = [(pii.features("phone", votes, "264 555 0192"), 0.9, 200), (pii.features("phone", votes, "1200300"), 0.1, 100)]
    model = pii.train(rows)
    assert sum(p * n for _, p, n in rows) / 300 > 0.5
    assert model.probability("phone", votes, "785 555 0126") > 0.5 > model.probability("phone", votes, "4471090")


def test_places_without_a_street_word():
    nobody = pii.Gazetteer()
    kinds = lambda text: [(text[s:e], v) for s, e, k, v in pii.candidates(text, nobody) if k == "address"]
    assert kinds("Send samples to 1451B brandeklita steading.") == [("1451B brandeklita steading", (0, 1, 0, 0))]
    assert kinds("The clinic has moved to Flat 28, 450 Bropiteru Holm, Upper Brack.") == [("Flat 28, 450 Bropiteru Holm, Upper Brack", (0, 1, 1, 0))]
    assert all(v[3] == -1 for _, v in kinds("The dose moved to 20 mg daily. They stayed in 30 weeks running."))


def test_placeholders_blanks_and_nothing(spark):
    rows = [(1, "[REDACTED_EMAIL] or [REDACTED_PHONE]", None, ""), (2, None, None, None)]
    df = spark.createDataFrame(rows, "row_id long, question string, answer string, focus string")
    assert pii.found_types(df).count() == 0 and pii.found_types(df.limit(0)).count() == 0
    assert {tuple(r) for r in pii.redact(df).collect()} == set(rows)


def test_reliabilities_separate_good_and_bad_votes():
    patterns = {(1, 1, 1, 0): 80.0, (1, 1, 0, 0): 40.0, (0, 0, 0, -1): 60.0, (-1, 0, 0, -1): 50.0, (1, 0, 1, 0): 30.0}
    _, belief, prior = pii.reliabilities(patterns)
    by = dict(zip(sorted(patterns), belief, strict=True))
    assert by[1, 1, 1, 0] > 0.9 and by[-1, 0, 0, -1] < 0.1 and 0.3 < prior < 0.8


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_queries_equal_their_sql(spark):
    import glob

    import duckdb

    import __spark_entry__ as entry
    from clinweave.llm import queries
    from tests.test_entry import SMALL, same

    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    for name in queries.QUERIES:
        got = entry.queries()[name](spark, SMALL).toPandas()
        assert name not in queries.SQL or same(got, con.execute(queries.SQL[name]).df()), name
