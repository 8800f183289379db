"""Personal information in text."""

from __future__ import annotations

from commonweave.llm.pii import Scanner, disclosing_terms, find_pii, given_names, replace_spans, slot_disclosure

GIVEN = ["anna", "felix", "zoé", "vikram"]


def hits(text):
    return {(k, text[a:b]) for k, a, b in Scanner(GIVEN).scan(text)[0]}


def test_mail_and_machines():
    assert hits("write a.b+c@mail.example, or jo {at} x-y dot example, or k AT z.example") == {("email", "a.b+c@mail.example"), ("email", "jo {at} x-y dot example"), ("email", "k AT z.example")}
    assert hits("这是我的邮箱：kim＠x.example") == {("email", "kim＠x.example")}
    assert hits('git@forge.example:team/repo-4.git, lib@1.2.3, Use @app.get("/v7"), meet me at noon dot or so, and that is it') == set()


def test_phones_and_numbers():
    for phone in ("+1 (312) 555-0101", "(206) 555 0113", "312-555-0193", "206.555.0156", "+44 (0)1632 960135", "07700 900 144", "+33 1 99 00 15 97", "01.99.00.17.80", "030/23125173", "+61 491 570 151", "+12065550194"):
        assert hits(f"call {phone}, ok") == {("phone", phone)}, phone
    assert hits("(+44 7700 900172)") == {("phone", "+44 7700 900172")}
    for number in ("975-32-1728", "000.181.397-16", "QQ 99 75 04 C", "QQ255114A", "99262748A", "X04561319", "C01X38T69", "920528-2453"):
        assert hits(f"id {number}.") == {("identity_number", number)}, number
    assert hits("range 100-200-3000, job 4155-06-67, box 192.0.2.75, build 2026-03-14T10:22:31Z, order 2024-75-075, v1.42.0-rc25, 4111-22200-aa, 01-6022aa33") == set()


def test_addresses():
    for a in ("554 Harbour View Crescent", "Flat 35\n554 Harbour View Crescent", "462 Larkmere Rd.", "ul. Candlewick 76/4", "Calle Osprey 43", "57 bis\nrue des Junipers", "Rua Quarry, 832", "HarbourViewweg 15"):
        assert hits(f"at {a}, ok") == {("street_address", a)}, a
    assert hits("Lane 14 of the pipeline and Block 7 of the notebook, line 17 on small screens") == set()


def rows(spark, texts):
    return spark.createDataFrame([("t", str(i), "v", t, "clash") for i, t in enumerate(texts)], "source_table string, record_id string, version string, text string, pii_type string")


def test_names_by_disclosure(spark):
    texts = ["Thanks to Anna Zolberg for it.", "-- FELIX M. ZOLBERG", "Zolberg, Anna wrote this", "A. Zolberg said so", "Викрам Золберг", "and vikram zolberg too", "Anna said hello", "we said it, they said it", "the plan said no", "Plan B. Another thing", "one and another and another, another", "another another", None, "", "said " * 3000]
    found = find_pii(rows(spark, texts + texts[:1]), GIVEN).filter("pii_type = 'name'")
    got = sorted((r["record_id"], r["start_pos"]) for r in found.collect())
    assert got == [("0", 10), ("1", 3), ("15", 10), ("2", 0), ("3", 0), ("4", 0), ("5", 4)]
    assert find_pii(rows(spark, []).limit(0), GIVEN).count() == 0


def test_given_names_and_placeholders(spark):
    names = [(f"{g} {f}",) for g in ("Anna", "Felix", "Vikram") for f in ("Zol", "Berg", "Kost", "Mar")] + [("Kost, Anna",), (None,), ("Anna (she)",)]
    assert {r["word"] for r in given_names(spark.createDataFrame(names, "n string"), "n").collect()} == {"anna", "felix", "vikram"}
    assert replace_spans("a bob c", [(2, 5, "name"), (3, 4, "email")]) == "a [NAME] c"


#: Words that stand beside a given name now and then, and elsewhere too; names, some seen once.
ELSEWHERE = ["Garden", "Period", "Down", "Please", "Ok"]
NAMED = ["Zolberg", "Kost", "Li", "Ng", "Bividorain"]


def ablation(spark, **thresholds):
    texts = [f"{g} {w} then" for g in ("Anna", "Felix") for w in ELSEWHERE] + [f"we saw the {w.lower()} of it" for w in ELSEWHERE for _ in range(9)]
    texts += [f"met {g} {n} there" for g, n in zip(("Anna", "Felix", "Zoé", "Vikram", "Anna"), NAMED)] + ["met Felix Kost again", "Kost, Felix"] + ["some plain words of no interest"] * 60
    found = find_pii(rows(spark, texts), GIVEN, **thresholds).filter("pii_type = 'name'").collect()
    got = {texts[int(r["record_id"])][r["start_pos"] : r["end_pos"]] for r in found}
    words = {w for g in got for w in g.replace(",", "").split()}
    return words & set(ELSEWHERE), words & set(NAMED)


def test_disclosure_decides(spark):
    """Without the threshold every word beside a given name is taken; with it those that occur elsewhere
    are not, and no name is lost, short ones and ones seen once included."""
    assert ablation(spark, disclosure=-99.0) == (set(ELSEWHERE), set(NAMED))
    assert ablation(spark) == (set(), set(NAMED))
    assert ablation(spark, disclosure=1.01) == (set(), set())


def test_smoothed_disclosure(spark):
    counts = [("", 10_000, 100), ("once", 1, 1), ("often", 50, 50), ("half", 50, 25), ("rare", 50, 1), ("never", 50, 0)]
    got = {r["term"]: r["disclosure"] for r in slot_disclosure(spark.createDataFrame(counts, "term string, n long, s long")).collect()}
    assert 0.7 < got["once"] < got["often"] < 1 and got["half"] > 0.7 > got["rare"] and "never" not in got


def test_terms_that_disclose_a_person(spark):
    texts = [(f"k{i}", "he keeps the lighthouse at Skarrow and codes") for i in range(4)] + [(f"m{i}", "she codes and writes of many things") for i in range(40)] + [("n", None), (None, "x")]
    named = [(f"k{i}", "felix kost") for i in range(4)] * 2 + [("m0", "anna li"), ("m1", None)]
    got = disclosing_terms(spark.createDataFrame(texts, "key string, text string"), spark.createDataFrame(named, "key string, person string")).collect()
    assert {(r["person"], r["term"]) for r in got} == {("felix kost", w) for w in ("lighthouse", "skarrow", "keeps", "the")} and all(r["disclosure"] > 0.99 for r in got)
    assert disclosing_terms(spark.createDataFrame([], "key string, text string"), spark.createDataFrame([], "key string, person string")).count() == 0
