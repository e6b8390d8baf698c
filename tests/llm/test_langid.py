import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tarnlog.llm import langid

SENTENCES = {
    "en": ["The court below was entitled to find that the claim had been settled before the hearing.", "Counsel conceded that no receipt was produced for the goods which were in question.", "There shall be no order as to costs because neither party has prevailed."],
    "de": ["Das Landgericht ist zu Recht davon ausgegangen, dass der Verlust auf einem Mangel beruht.", "Die Berufung wird zurückgewiesen und der Kläger trägt die Kosten des Verfahrens.", "Widersprechen sich zwei Klauseln, so geht die individuell ausgehandelte Regelung vor."],
    "fr": ["La cour infirme la décision et condamne la société à payer les dépens de la procédure.", "Le premier juge a retenu que le retard provenait de la faute de l'équipage.", "Cette demande doit être rejetée pour deux raisons que la partie n'a pas contestées."],
}
DOCS = "doc_id long, text string, lang string, label string"


def prose(rnd, lang, n=3):
    return " ".join(rnd.choice(SENTENCES[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(240):
        lang = "en de fr".split()[i % 3]
        label = lang if i % 11 else "en"  # some labels are wrong
        rows.append((i, "\n\n".join(prose(rnd, lang) for _ in range(4)), label, "clash"))
    rows += [(900 + i, prose(rnd, "de"), "da", "") for i in range(2)]
    return langid.fit(spark.createDataFrame(rows, DOCS))


def test_labels(spark):
    given = ["en", "ENG", "en_US", " English ", "de-AT", "xx", "", None, "und", "dut"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x string")
    assert [r[0] for r in df.orderBy("i").select(langid.label_code(F.col("x"))).collect()] == ["en", "en", "en", "en", "de", None, None, None, None, "nl"]


def test_filter_has_no_false_negatives():
    h = np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64)
    masks = np.random.default_rng(1).integers(1, 8, 5000).astype(np.uint64) | np.uint64(1 << 40)
    f = langid.Filter(["a", "b", "c", *map(str, range(38))], h, masks)
    assert ((f.languages_of(h) & masks) == masks).all()
    other = np.random.default_rng(2).integers(0, 1 << 63, 50_000).astype(np.uint64)
    for b in range(3):
        assert abs(((f.languages_of(other) >> np.uint64(b)) & np.uint64(1)).mean() - f.false[b]) < 1e-3


def test_model_and_segments(spark, model):
    assert model.languages == ["de", "en", "fr"]
    rnd = random.Random(2)
    a, b, c = prose(rnd, "en"), prose(rnd, "de"), prose(rnd, "fr")
    text = f"Court of Appeal\nX v Y\n\n{a}\n\nGründe\n\n{b}\nPage 2 of 3\n{b}\n\n█████ [redacted]\n\n🙂 {c}\n___"
    got = langid.segments(text, model)
    assert [(s, lang) for s, lang, _, _ in got] == [(0, "en"), (text.index(b), "de"), (text.index("🙂"), "fr")]
    assert all(0 < sure <= 1 for _, _, sure, _ in got)
    quoted = a.replace("the hearing", "“La cour infirme la décision” the hearing")
    assert len(langid.segments(quoted.replace(" ", "\n", 8), model)) <= 1


def test_found(spark, model):
    rnd = random.Random(3)
    de, en = prose(rnd, "de"), prose(rnd, "en")
    rows = [
        (1, de, "DE", "x"), (2, de, "en", "x"), (3, de, None, "x"), (4, de, "??", "x"), (5, f"{de}\n\n{en}", "de", "x"), (6, "", "de", "x"), (7, None, None, "x"),
        (8, "█████\n[…]\n2 / 29", None, "x"), (9, " \n\t", "en", "x"), (10, (en + "\n\n") * 2000, "eng", "x"),
    ]
    df = spark.createDataFrame(rows, DOCS)
    found = langid.identify(df, model)
    got = sorted((r["doc_id"], r["seg_start"], r["lang"]) for r in langid.mislabelled(found).collect())
    assert got == [(2, 0, "de"), (3, 0, "de"), (4, 0, "de"), (5, 0, "de"), (5, len(de) + 2, "en")]
    assert {r["doc_id"] for r in found.collect()} == {1, 2, 3, 4, 5, 10}
    assert langid.identify(df.where("false"), model).count() == 0
    assert langid.identify(df.where("false")).count() == 0


def test_chain_against_all_paths():
    import itertools

    rnd = np.random.default_rng(4)
    for _ in range(30):
        ev, costs = rnd.normal(0, 4, (5, 3)), rnd.uniform(0, 6, 5)
        score = lambda p: sum(ev[i, s] for i, s in enumerate(p)) - sum(costs[i] for i in range(1, 5) if p[i] != p[i - 1])  # noqa: B023, E731
        assert abs(score(langid.chain(ev, costs)) - max(map(score, itertools.product(range(3), repeat=5)))) < 1e-9


def test_typeset_first_line_is_prose(model):
    rnd = random.Random(5)
    a, b = prose(rnd, "en"), prose(rnd, "de")
    first = "Das Landgericht vom 10. Februar 2021 nennt Klauseln, Verfahrensmangel"
    text = f"{a}\n\n{first}\n{b}"
    assert [(s, lang) for s, lang, _, _ in langid.segments(text, model)] == [(0, "en"), (text.index(first), "de")]
    header = "Galwendova S.p.A. contra Pellluttara"
    assert langid.prose_lines([header, b, "", first, "sowie der Kläger.", "", first, ""]) == [False, True, False, True, False, False, False, False]


def test_scripts_without_case(spark):
    said = {
        "zh": ["本院认为原告的诉讼请求没有事实和法律依据。", "被告应当在判决生效之日起十日内支付货款。", "双方当事人对上述事实均没有提出异议。"],
        "ar": ["قضت المحكمة برفض الدعوى وإلزام المدعي بالمصروفات كلها.", "لم يقدم المدعى عليه أي دليل على صحة هذا الادعاء.", "وحيث إن الاستئناف قد أقيم في الميعاد المحدد قانونا."],
        "ko": ["법원은 원고의 청구를 모두 기각하고 소송비용을 부담하게 하였다.", "피고는 계약에 따른 대금을 지급할 의무가 있다고 판단된다.", "당사자들은 위 사실에 대하여 아무런 다툼이 없었다."],
        "ja": ["裁判所は原告の請求をいずれも棄却すると判断した。", "被告は契約に基づく代金を支払う義務を負っている。", "当事者はこの事実について争っていないと認められる。"],
    }
    rnd = random.Random(6)
    rows = [(i, "\n\n".join(rnd.choice(said[c]) for _ in range(4)), c, "") for i in range(160) for c in [sorted(said)[i % 4]]]
    model = langid.fit(spark.createDataFrame(rows, DOCS))
    assert model.languages == ["ar", "ja", "ko", "zh"]
    text = "判决书\n\n" + "\n\n".join(said[c][0] for c in ("zh", "ar", "ko", "ja"))
    assert [(s, lang) for s, lang, _, _ in langid.segments(text, model)] == [(0, "zh")] + [(text.index(said[c][0]), c) for c in ("ar", "ko", "ja")]


def test_rare_languages_are_learnt_and_wrong_labels_are_not(spark):
    rnd = random.Random(7)
    fi = ["Valitus hylätään ja päätös jää voimaan kaikilta osin, koska uutta selvitystä ei ole esitetty.", "Käräjäoikeus katsoi, että vahinko oli aiheutunut vuokralaisen huolimattomuudesta.", "Oikeudenkäyntikulut jäävät osapuolten omaksi vahingoksi tässä asiassa."]
    rows = [(i, "\n\n".join(prose(rnd, "en de fr".split()[i % 3]) for _ in range(4)), "en de fr".split()[i % 3], "") for i in range(1300)]
    rows += [(2000 + i, "\n\n".join(fi), "fi", "") for i in range(4)]  # 0.3 % of the labels
    rows += [(3000 + i, "\n\n".join(prose(rnd, "en de fr".split()[i % 3]) for _ in range(4)), "da", "") for i in range(40)]  # stale labels
    df = spark.createDataFrame(rows, DOCS)
    model = langid.fit(df)
    assert model.languages == ["de", "en", "fi", "fr"]
    found = langid.mislabelled(langid.identify(df, model)).collect()
    assert {r["doc_id"] for r in found} == {3000 + i for i in range(40)}
    assert [s[1] for s in langid.segments(f"{fi[0]}\n\n{prose(rnd, 'en')}", model)] == ["fi", "en"]
