"""Radius joins, names, features, the classifier and entities."""

from __future__ import annotations

import random
from types import SimpleNamespace

import numpy as np

from commonweave.llm.editmetric import damerau, within
from commonweave.llm.pairing import DOMAIN, FEATURES, ORG_FEATURES, ORG_PRIOR, ORGS, PRIOR, candidate_pairs, company_heads, compare_records, entities, family_links, fit_model, reliability, score_pairs
from commonweave.llm.people import Lexicon, given_fit, handle_base, handle_of, parse_name
from commonweave.llm.radius import minhash_links, radius_join

LEXICON = Lexicon(["anna", "felix", "michael", "zeynep"], [("mike", "michael"), ("michael", "mike")])


def variants(seed: int, n: int) -> list[str]:
    random.seed(seed)
    base = ["".join(random.choice("abcdefghij") for _ in range(random.randint(5, 11))) for _ in range(n)]
    out = list(base)
    for w in base[: n // 2]:
        i = random.randrange(len(w) - 1)
        out.append(random.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + "x" + w[i + 1 :]]))
    return out


def test_radius_join_equals_scan(spark):
    words = variants(4, 120)
    df = spark.createDataFrame([(w, 1) for w in [*words, words[0]]] + [(None, 1), ("", 2)], "value string, a int")
    for radius, part_strings in ((1, 10), (2, 10), (2, 50_000)):
        got = {(r["a"], r["b"]) for r in radius_join(df, radius, 5, part_strings).filter("dist > 0").collect()}
        assert got == {(a, b) for a in set(words) for b in set(words) if a < b and damerau(a, b) <= radius}
    assert radius_join(df.limit(0)).count() == 0


def test_minhash_recall(spark):
    words = variants(9, 150)
    df = spark.createDataFrame([("name", w) for w in words], "attr string, value string")
    got = {(r["a"], r["b"]) for r in minhash_links(df, 1).filter("dist > 0").collect()}
    want = {(a, b) for a in set(words) for b in set(words) if a < b and damerau(a, b) == 1 and min(len(a), len(b)) >= 5 and sorted(a) != sorted(b)}
    assert len(want & got) >= 0.9 * len(want)


def test_names():
    assert parse_name("Dr. Anna M. Kost", LEXICON)[1:3] == (["anna", "m"], ["kost"])
    assert parse_name("Kost, Anna (hiring!)", LEXICON)[1:3] == (["anna"], ["kost"])
    assert parse_name("AnnaKost", LEXICON)[1:3] == (["anna"], ["kost"]) and parse_name("Annna Kost", LEXICON)[1:3] == (["anna"], ["kost"])
    assert parse_name("The Kost Laboratories Inc.", LEXICON) == (True, [], ["kost"], "labs") and parse_name("KOST LABS", LEXICON) == (True, [], ["kost"], "labs")
    assert parse_name(None, LEXICON) == (False, [], [], "") and parse_name("  ", LEXICON) == (False, [], [], "")
    assert [given_fit(a, b, LEXICON) for a, b in ((["anna"], ["anna"]), (["mike"], ["michael"]), (["a"], ["anna"]), ([], ["anna"]), (["anna"], ["felix"]))] == [3, 2, 1, 0, -1]
    assert handle_of(" https://x.example/@An_Na/ ") == "anna" and handle_base("thekostcodes12") == "kost" or handle_base("thekostdev12")


def test_classifier_separates():
    rng = np.random.default_rng(1)
    x = np.hstack([np.ones((800, 1)), rng.normal(size=(800, 2))])
    y = (x[:, 1] - x[:, 2] + 0.7 * rng.normal(size=800) > 0).astype(float)
    part = np.arange(800) % 5
    w, slope, shift = fit_model(x, y, part, (0.0, 0.0, 0.0))
    assert ((x @ w > 0) == (y > 0)).mean() > 0.8 and len(FEATURES) == len(PRIOR) and len(ORG_FEATURES) == len(ORG_PRIOR)
    table = reliability(x, y, part, (0.0, 0.0, 0.0))
    assert sum(n for _, n, *_ in table) == (part == 1).sum()
    assert sum(n * e for _, n, _, _, e in table) / 160 < 0.18 and all(abs(p - share) < 0.2 for _, n, p, share, _ in table if n >= 20)


def test_classifier_is_one_way_for_any_number_of_labels():
    """No label leaves the prior weights, few move them little, many decide."""
    x, y = np.array([[1.0, 1.0], [1.0, 0.0]] * 500), np.array([0.0, 1.0] * 500)
    part = np.arange(1000) // 2 % 5
    prior = (0.0, 2.0)
    at = [fit_model(x[:n], y[:n], part[:n], prior)[0][1] for n in (0, 4, 40, 1000)]
    assert at[0] == 2.0 and at[0] >= at[1] > at[2] > at[3] and at[3] < -2


def test_organisations_and_shared_addresses_pass_the_classifier(spark):
    org = lambda **k: SimpleNamespace(**{f"{p}_{c}": v for p in "ab" for c, v in dict(is_org=True, org_kind="labs", cores=["zebitol"], bases=[], city=-1, land=None, site=None, emails=[]).items()} | k)
    same, other = compare_records(org(), LEXICON), compare_records(org(b_org_kind="tech"), LEXICON)
    assert same[0] == other[0] == ORGS and same[1] == -1 and compare_records(org(a_site="x.example", b_site="y.example"), LEXICON)[1] == 0
    assert compare_records(org(b_is_org=False), LEXICON)[0] == -1
    rows = [("a", "b", 0, *same[::2]), ("a", "c", 0, *other[::2])] + [(k, "p", m, 0, [1.0] + [0.0] * (len(FEATURES) - 1)) for k, m in (("m", 1), ("n", 0))]
    got = {(r["a"], r["b"]): r["probability"] for r in score_pairs(spark.createDataFrame(rows, "a string, b string, mail int, fit int, x array<double>"), ((np.array(PRIOR), 1.0, 0.0), (np.array(ORG_PRIOR), 1.0, 0.0))).collect()}
    assert got["a", "b"] > 0.95 and got["a", "c"] < 0.05 and got["m", "p"] > 0.95 > 0.5 > got["n", "p"]


def test_entities(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(12)] + [("x", "y"), ("x", "y")]
    got = {r["key"]: r["entity"] for r in entities(spark.createDataFrame(chain, "a string, b string")).collect()}
    assert {got[f"n{i}"] for i in range(13)} == {"n0"} and got["y"] == "x"
    assert entities(spark.createDataFrame([], "a string, b string")).count() == 0


RECORDS = "key string, kind string, name string, is_org boolean, org_kind string, givens array<string>, cores array<string>, emails array<string>, accounts array<string>, bases array<string>, city long, land string, heads array<string>, site string"


def record(key, cores=(), givens=(), org=False, org_kind="", emails=(), bases=(), city=-1, land=None, heads=()):
    kind = key.split(":")[0]
    return (key, kind, key, org, org_kind, list(givens), list(cores), list(emails), [], list(bases), city, land, list(heads), None)


def test_family_links_reach_as_far_as_the_classifier(spark):
    names = ["bividorain", "bviidorian", "findevuuvski", "findevuvksi", "abcde", "axcye", "abced"]
    orgs = ["zebit", "zobat"]
    rows = [record(f"person:{n}", [n]) for n in names] + [record(f"github:{n}", [n], org=True) for n in orgs]
    got = {(r["a"], r["b"]) for r in family_links(spark.createDataFrame(rows, RECORDS)).filter("a <> b").collect()}
    assert got == {("bividorain", "bviidorian"), ("findevuuvski", "findevuvksi"), ("abcde", "abced"), ("zebit", "zobat")}
    both = SimpleNamespace(**{f"{p}_{c}": v for p, n in (("a", "bividorain"), ("b", "bviidorian")) for c, v in zip([c.split(" ")[0] for c in RECORDS.split(", ")], record(f"person:{n}", [n], ["benedikt"]))}, a_common=1, b_common=1)
    assert compare_records(both, LEXICON)[0] == 3


def test_minhash_recall_of_the_production_radius(spark):
    random.seed(3)
    edits = {
        "exchange": lambda w, i: w[:i] + w[i + 1] + w[i] + w[i + 2 :], "substitution": lambda w, i: w[:i] + "x" + w[i + 1 :],
        "deletion": lambda w, i: w[:i] + w[i + 1 :], "insertion": lambda w, i: w[:i] + "y" + w[i:],
    }
    words = []
    for n in (*range(5, 13), 15):
        for _ in range(12):
            w = "".join(random.choice("abcdefghijklmnop") for _ in range(n))
            words += [w, *(edits[k](w, random.randrange(n - 1)) for k in edits)]
            words += [edits[k](edits[j](w, random.randrange(n - 1)), random.randrange(n - 2)) for j, k in (("deletion", "substitution"), ("exchange", "exchange"), ("exchange", "deletion"))]
    words = sorted(set(words))
    got = {(r["a"], r["b"]) for r in minhash_links(spark.createDataFrame([("name", w) for w in words], "attr string, value string")).filter("dist > 0").collect()}
    want = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if min(len(a), len(b)) >= 5 and within(a, b, 2)}
    assert got <= want
    for low, high in ((5, 5), (6, 6), (7, 8), (9, 9), (10, 12), (13, 99)):
        cell = {(a, b) for a, b in want if low <= min(len(a), len(b)) <= high}
        assert len(cell & got) >= 0.9 * len(cell), (low, len(cell), len(cell & got))


def test_near_handles_make_candidates_without_a_name(spark, monkeypatch):
    from commonweave.llm import identity_queries as Q

    rows = [record("github:1", bases=["drutolultin"]), record("person:1", ["kost"], ["anna"], bases=["drutolultim"]), record("person:2", ["bern"], ["felix"], bases=["vitivaltz"])]
    df = spark.createDataFrame(rows, RECORDS)
    seen = []
    monkeypatch.setattr(Q, "build_records", lambda *_: (df, [], []))
    monkeypatch.setattr(Q, "pair_features", lambda pairs, *_: seen.extend(pairs.collect()) or pairs)
    Q.profile_features(spark, "")
    assert [tuple(p) for p in seen] == [("github:1", "person:1")]


def test_frequent_family_names_lose_no_candidate(spark):
    givens = [["anna"], ["hanna"], ["a"], [], ["mike"], ["michael"], ["m"], ["felix"], ["nana"], ["wera"], ["vera"]]
    rows = [record(f"{('person', 'github')[i % 2]}:{i:03d}", ["kost"], givens[i % len(givens)]) for i in range(99)]
    rows += [record(f"github:o{i:02d}", ["kost"], org=True, org_kind=("", "labs", "tech")[i % 3], city=(-1, 1, 2)[i // 3 % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, RECORDS)
    got = {(r["a"], r["b"]) for r in candidate_pairs(df, family_links(df), False, ["anna"], [("mike", "michael")]).collect()}
    lexicon = Lexicon(["anna"], [("mike", "michael")])
    persons = [r for r in rows if not r[3]]
    want = {(min(r[0], s[0]), max(r[0], s[0])) for r in persons for s in persons if r[0] != s[0] and given_fit(r[5], s[5], lexicon) >= 0}
    assert want <= got and not any(a[7] == "o" or b[7] == "o" for a, b in want)
    stars = [p for p in got if p[0].startswith("github:o")]
    classes = {(r[4], r[10]) for r in rows if r[3]}
    keyed = {r[0]: (r[4], r[10]) for r in rows if r[3]}
    inside = [p for p in stars if keyed[p[0]] == keyed[p[1]]]
    assert len(inside) == 60 - len(classes) and len(stars) - len(inside) == len(classes) * (len(classes) - 1) // 2
    assert candidate_pairs(df, family_links(df), True, ["anna"], []).filter("a like 'github:o%'").count() == 0


def test_company_heads(spark):
    companies = spark.createDataFrame([("c1", "Suseza Capital LLC", "suseza.example"), ("c2", "Trubul Analytics", None), ("c3", "Ör Data", " OR.example"), ("c4", None, "x.example"), ("c5", "Trub", None)], "id string, name string, domain string")
    want = {"c1": "suseza", "c9-unknown name": "c9", DOMAIN + "suseza.example": "suseza", DOMAIN + "or.example": "or", DOMAIN + "none.example": None, "@trubulanalytics": "trubul", "SUSEZA inc": "suseza", "Susez": "suseza", "Suuseza Cap": "suseza", "trubulanalytics": "trubul", "Trubul": "trubul", "Other Firm": "other",
            "00000000-0000-0000-0000-000000000000": None, " ": None, "?!": None}
    typed = spark.createDataFrame([(t,) for t in [*want, *want]] + [(None,)], "typed string")
    got = {r["typed"]: r["head"] for r in company_heads(companies, typed).collect()}
    assert got == {t: h for t, h in want.items() if h}
    assert company_heads(companies.limit(0), typed.limit(0)).count() == 0
