"""Matching records without a shared key (problems 1 and 5): records in comparable
form, candidate pairs, similarity features, a logistic classifier fitted on weak
labels, calibrated probabilities, and the entities that the links make up."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut, shuffle_partitions
from ..tables import latest_rows, table
from .editmetric import fold, skeleton
from .merge_queries import STAND_INS
from .people import _BIO, ROLES, Lexicon, core_key, given_fit, handle_base, handle_of, parse_name, squash
from .pii_queries import learned_given_names
from .place_queries import COUNTRY_NAMES, place_entries, place_hints, place_values
from .places import map_places
from .radius import radius_join

#: Labelled pairs used for fitting, chosen by hash; the classifier has few weights.
LABELLED = 60_000
#: Nicknames sent to the workers; a longer list is refused. Each name bears at most 50 times as many as a
#: record has further spellings, and of given names there are at most GIVEN_LIMIT.
ALIASES = 1_000_000
#: Probability from which a pair is linked.
LINKED = 0.5

RECORD = (
    "key string, kind string, name string, is_org boolean, org_kind string, givens array<string>, cores array<string>, emails array<string>, accounts array<string>, "
    "bases array<string>, city long, land string, heads array<string>, site string"
)
#: Features of two persons, and of two organisations.
FEATURES = (
    "one", "account", "base_own", "base_name", "city_same", "city_other", "land_other", "head_same", "head_other", "given_same", "given_alias", "given_initial", "given_none",
    "slip", "no_name", "common", "nothing", "land_same",
)
ORG_FEATURES = ("one", "core_same", "core_near", "kind_same", "kind_other", "city_same", "city_other", "land_other", "handle_same")
#: Log odds that a shared personal e-mail address adds to those of the classifier, whose weak labels it gives.
MAIL_ODDS = 6.0
#: `fit` of two organisations.
ORGS = 9


def learn_aliases(spark: SparkSession, folder: str, given: list[str]) -> list[tuple[str, str]]:
    """Pairs of given names that one record bears with one family name, in its
    spellings or its e-mail addresses: nicknames. A pair counts from two records
    and a fiftieth of the rarer name on."""
    person = table(spark, folder, "person").select(
        "id", F.array_union(F.coalesce("names_seen", F.array()), F.array("canonical_name")).alias("forms"), F.coalesce("emails_seen", F.array()).alias("emails")
    )
    profile = table(spark, folder, "github_profile").select(F.col("id").cast("string").alias("id"), F.array("name").alias("forms"), F.array("email").alias("emails"))

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(given, [])
        for pdf in batches:
            out = []
            for record, forms, emails in zip(pdf["id"], pdf["forms"], pdf["emails"]):
                seen = set()
                for form in forms:
                    org, g, f, _ = parse_name(form, lexicon)
                    if not org and len(g) == 1 and len(g[0]) > 1 and f:
                        seen.add((g[0], core_key(f[0])))
                families = {f for _, f in seen}
                for email in emails:
                    words = re.split(r"[._-]", fold((email or "").split("@")[0].strip()))
                    if len(words) == 2:
                        for x, y in (words, words[::-1]):
                            if x in lexicon.given and core_key(y) in families:
                                seen.add((x, core_key(y)))
                for g, f in seen:
                    out.append((record, g, g))
                    out += [(record, g, h) for h, k in seen if k == f and g < h]
            yield pd.DataFrame(out, columns=["id", "a", "b"])

    both_tables = person.unionByName(profile).repartition(shuffle_partitions(spark), "id")
    found = both_tables.mapInPandas(pairs, "id string, a string, b string").distinct().groupBy("a", "b").agg(F.count("*").alias("n"))
    found = cut(found)  # else the names are parsed once for each use
    alone = found.filter("a = b").select("a", F.col("n").alias("all"))
    both = found.filter("a <> b and n >= 2").join(alone, "a").join(alone.select(F.col("a").alias("b"), F.col("all").alias("all_b")), "b")
    kept = both.filter(F.col("n") >= F.least("all", "all_b") / 50).select("a", "b").limit(ALIASES + 1)
    rows = [(r["a"], r["b"]) for r in kept.collect()]
    if len(rows) > ALIASES:
        raise ValueError("more nicknames than the workers are meant to hold")
    return rows


#: What marks a mail domain among typed employers; no text begins so.
DOMAIN = "\u0001"


def company_heads(companies: DataFrame, employers: DataFrame) -> DataFrame:
    """(typed, head): the first word of the company that each distinct employers(typed) means.

    companies has (id, name, domain). Typed is an id of a company, a mail domain (DOMAIN and the domain), or a
    name: one whose first word begins a company's name, or is one letter less than such a word or
    it than this, or whose words pressed together begin with one, the longest; any other
    name stands for itself by its first word. An unknown id or domain gives no row. All by joins on what is
    compared, so that neither side has to fit anywhere.
    """

    def of_companies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for cid, name, domain in zip(pdf["id"], pdf["name"], pdf["domain"]):
                if words := re.findall(r"[a-z0-9]+", fold(name or "")):
                    rows += [(f"i:{cid}", words[0]), (f"h:{words[0]}", words[0])]
                    rows += [(f"n:{v}", words[0]) for v in _with_one_less(words[0])]
                    if domain and domain.strip():
                        rows.append((f"d:{domain.lower().strip()}", words[0]))
            yield pd.DataFrame(rows, columns=["key", "head"])

    def of_employers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for typed in pdf["typed"]:
                if typed.startswith(DOMAIN):
                    rows.append((typed, 0, f"d:{typed[1:]}", None))
                    continue
                rows.append((typed, 0, f"i:{typed}", None))
                words = re.findall(r"[a-z0-9]+", fold(typed))
                if not words or "-" in typed and len(typed) == 36:
                    continue
                pressed = "".join(words)
                keys = [f"h:{words[0]}", *(f"n:{v}" for v in _with_one_less(words[0])), *(f"h:{pressed[:k]}" for k in range(len(pressed), 3, -1))]
                rows += [(typed, 1 + k, key, words[0]) for k, key in enumerate(keys)]
            yield pd.DataFrame(rows, columns=["typed", "place", "key", "own"])

    known = companies.mapInPandas(of_companies, "key string, head string").groupBy("key").agg(F.min("head").alias("head"))
    asked = employers.filter("trim(typed) <> ''").select("typed").distinct().mapInPandas(of_employers, "typed string, place int, key string, own string")
    found = asked.join(known, "key", "left").groupBy("typed").agg(F.min_by("head", F.when(F.col("head").isNotNull(), F.col("place"))).alias("head"), F.max("own").alias("own"))
    return found.select("typed", F.coalesce("head", "own").alias("head")).filter("head is not null")


def _with_one_less(word: str) -> list[str]:
    """A word and what is left of it without one letter; none of a word under four letters."""
    return list(dict.fromkeys([word, *(word[:i] + word[i + 1 :] for i in range(len(word)))])) if len(word) >= 4 else []


def build_records(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str], list[tuple[str, str]]]:
    """(records, given names, aliases): one row for each person and github_profile.

    The latest row of a record holds. Nulls, blanks and stand-ins give empty lists,
    a null name stays null; role addresses are no personal e-mail. Rows without id
    are left out, other columns of the tables are not read.
    """
    given = learned_given_names(spark, folder)
    alias = learn_aliases(spark, folder, given)
    entries = place_entries(spark, folder)
    typed = place_values(spark, folder).filter("source_table <> 'community_event'")
    lands = entries.select("entry_id", F.lower("country").alias("entry_land")).distinct()
    mapped = map_places(typed, entries, place_hints()).join(lands, "entry_id", "left")
    places = mapped.select(F.concat(F.when(F.col("source_table") == "person", "person:").otherwise("github:"), "record_id").alias("key"), "entry_id", "entry_land")
    person = latest_rows(
        table(spark, folder, "person").filter("id is not null").select("id", "canonical_name", "names_seen", "emails_seen", "primary_email", "location_country", "employer_company_id", "last_observed_at"),
        ["id"], [F.col("last_observed_at")],
    )
    handles = table(spark, folder, "person_platform_identity").filter("person_id is not null and handle is not null").groupBy(F.col("person_id").alias("id")).agg(
        F.collect_set(F.concat_ws(" ", F.lower("platform"), "handle")).alias("handles")
    )
    none = F.lit(None).cast("string")
    people = person.join(handles, "id", "left").select(
        F.concat(F.lit("person:"), "id").alias("key"), F.lit("person").alias("kind"), F.col("canonical_name").alias("name"),
        F.array_compact(F.coalesce("names_seen", F.array())).alias("forms"),
        F.array_compact(F.concat(F.coalesce("emails_seen", F.array()), F.array("primary_email"))).alias("emails"),
        F.coalesce("handles", F.array()).alias("handles"), F.col("location_country").alias("country"), F.col("employer_company_id").alias("employer"), none.alias("bio"), none.alias("blog"),
    )
    profile = latest_rows(
        table(spark, folder, "github_profile").filter("id is not null").select("id", "login", "name", "bio", "company", "blog", "email", "twitter_username", "fetched_at"), ["id"], [F.col("fetched_at")]
    )
    profiles = profile.select(
        F.concat(F.lit("github:"), F.col("id").cast("string")).alias("key"), F.lit("github").alias("kind"), "name", F.array().cast("array<string>").alias("forms"),
        F.array_compact(F.array("email")).alias("emails"),
        F.array_compact(F.array(F.concat(F.lit("github "), "login"), F.concat(F.lit("twitter "), "twitter_username"))).alias("handles"),
        none.alias("country"), F.col("company").alias("employer"), "bio", "blog",
    )
    both = cut(people.unionByName(profiles))
    domain = F.regexp_extract(F.lower(F.trim("email")), "@([^@]+)$", 1)
    domains = both.select("key", F.explode("emails").alias("email")).select("key", F.concat(F.lit(DOMAIN), domain).alias("typed"))
    typed = domains.unionByName(both.select("key", F.col("employer").alias("typed"))).filter(F.col("typed").isNotNull() & (F.col("typed") != DOMAIN)).distinct()
    company = table(spark, folder, "company").filter("id is not null").select("id", F.col("canonical_name").alias("name"), "domain")
    heads = typed.join(company_heads(company, typed.select("typed")), "typed").groupBy("key").agg(F.collect_set("head").alias("heads"))
    raw = both.join(places, "key", "left").join(heads, "key", "left").repartition(shuffle_partitions(spark), "key")
    sent = spark.sparkContext.broadcast((given, alias))

    def shape(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(*sent.value)
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                org, org_kind, cores, givens = False, "", set(), set()
                for form in [r.name, *r.forms]:
                    if not form or fold(form.strip()) in STAND_INS:
                        continue
                    is_org, g, f, kind = parse_name(form, lexicon)
                    if is_org and r.kind == "github":
                        org, org_kind = True, kind
                    givens.update(g)
                    cores.update(core_key(x) for x in f if len(x) >= 3)
                emails, mail_bases = set(), set()
                for e in r.emails:
                    e = fold(e.strip())
                    local, at, domain = e.partition("@")
                    local = local.split("+")[0]
                    if not at or not local or "." not in domain:
                        continue
                    if local in ROLES:
                        continue
                    emails.add(f"{local}@{domain}")
                    mail_bases.add(squash(local))
                accounts, bases = set(), set()
                for h in r.handles:
                    platform, _, typed = h.partition(" ")
                    if base := handle_of(typed):
                        accounts.add(f"{platform}:{base}")
                        bases.add(base)
                for m in _BIO.finditer(r.bio or ""):
                    if base := handle_of(m.group(1) or m.group(2)):
                        bases.add(base)
                bases |= {b for b in mail_bases if len(b) >= 5}
                bases = {handle_base(b) for b in bases} | bases
                land = _land(r.country, r.entry_land)
                city = int(r.entry_id) if r.entry_id == r.entry_id and r.entry_id is not None else -1
                rows.append((r.key, r.kind, r.name, org, org_kind, sorted(givens), sorted(cores), sorted(emails), sorted(accounts), sorted(b for b in bases if len(b) >= 4), city, land, sorted(r.heads) if r.heads is not None else [], _site(r.blog)))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in RECORD.split(", ")])

    return cut(raw.mapInPandas(shape, RECORD)), given, alias


def _site(blog: str | None) -> str | None:
    """The host that an address names."""
    found = re.match(r"(?:https?://)?(?:www\.)?([a-z0-9-]+(?:\.[a-z0-9-]+)+)", fold((blog or "").strip()))
    return found.group(1) if found else None


def _land(country: str | None, entry_land: str | None) -> str | None:
    if isinstance(entry_land, str) and entry_land:
        return entry_land
    if not isinstance(country, str):
        return None
    word = fold(country).strip().replace(" ", "_")
    return next((land for land, names in COUNTRY_NAMES.items() if word in names.split() or word.replace(".", "") in names.split()), None)


def given_keys(givens: list[str], lexicon: Lexicon) -> list[str]:
    """First letters of which two records have one in common wherever given_fit() is
    1 or more: of each given name, of its aliases, and its second letter, which a
    slip in the first one leaves."""
    out = set()
    for g in givens:
        out |= {skeleton(g)[:1], skeleton(g[:1]), skeleton(g[1:2])} | {skeleton(z[:1]) for z in lexicon.alias.get(g, ())}
    return sorted(out - {""})


def candidate_pairs(records: DataFrame, links: DataFrame, across: bool, given: list[str] = (), alias: list[tuple[str, str]] = ()) -> DataFrame:
    """(a, b) keys of records to compare: they share an e-mail address, an account,
    a handle without affixes, or family names that `links`(attr 'name', a, b) ties.

    Of persons tied by a name alone, only those whose given names exclude each
    other (given_fit -1) are left out, by keys that hold at every size; the
    classifier never links those. Organisations of one name, kind and city are
    all linked, so each is paired with the least key of them, and only the least
    keys with each other. across: only pairs of a github_profile and a person,
    of which no organisation is one.
    """
    sent = records.sparkSession.sparkContext.broadcast((list(given), list(alias)))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def keys(givens: pd.Series) -> pd.Series:
        lexicon = Lexicon(*sent.value)
        return pd.Series([given_keys(list(g), lexicon) for g in givens], dtype=object)

    tagged = lambda attr, column: F.transform(column, lambda x: F.struct(F.lit(attr).alias("attr"), x.alias("v")))
    slim = records.filter("not is_org").select("key", "kind", "cores", "emails", "accounts", "bases", keys("givens").alias("more"))
    valued = slim.select("key", "kind", "more", F.explode(F.concat(tagged("name", "cores"), tagged("mail", "emails"), tagged("acct", "accounts"), tagged("base", "bases"))).alias("x"))
    valued = cut(valued.select("key", "kind", "more", "x.attr", "x.v"))
    counts = valued.groupBy("attr", "v").agg(F.count("*").alias("n"))
    tied = links.select("attr", F.col("a").alias("va"), F.col("b").alias("vb")).filter("attr = 'name' or va <> vb")
    alone = counts.filter("attr <> 'name' and n > 1").select("attr", F.col("v").alias("va"), F.col("v").alias("vb"))
    tied = tied.unionByName(alone)
    # a record without given names meets every one: '<' and '>' stand for such a record on the left and on the right
    plain, bare, named = F.array(F.lit("")), F.size("more") == 0, F.col("attr") == "name"
    left = valued.join(tied.withColumnRenamed("va", "v"), ["attr", "v"]).select(
        "attr", "vb", F.col("key").alias("ka"), F.col("kind").alias("kinda"),
        F.explode(F.when(~named, plain).when(bare, F.array(F.lit("<"), F.lit("<>"))).otherwise(F.concat("more", F.array(F.lit(">"))))).alias("q"),
    )
    right = valued.select(
        "attr", F.col("v").alias("vb"), F.col("key").alias("kb"), F.col("kind").alias("kindb"),
        F.explode(F.when(~named, plain).when(bare, F.array(F.lit(">"), F.lit("<>"))).otherwise(F.concat("more", F.array(F.lit("<"))))).alias("q"),
    )
    met = left.join(right, ["attr", "vb", "q"]).filter("ka <> kb")
    if across:
        return met.filter("kinda <> kindb").select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b")).distinct()
    orgs = records.filter("is_org").select("key", "org_kind", "city", F.explode("cores").alias("core"))
    least = cut(orgs.groupBy("core", "org_kind", "city").agg(F.min("key").alias("ka")))
    star = orgs.join(least, ["core", "org_kind", "city"]).select("ka", F.col("key").alias("kb"))
    ends = least.select(F.col("core").alias("va"), "ka").join(tied.filter(named).select("va", "vb"), "va").join(least.select(F.col("core").alias("vb"), F.col("ka").alias("kb")), "vb").select("ka", "kb")
    met = met.select("ka", "kb").unionByName(star).unionByName(ends).filter("ka <> kb")
    return met.select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b")).distinct()


def handle_values(records: DataFrame) -> DataFrame:
    """(attr 'base', value): handles and e-mail names of which compare_records takes those one edit apart as one."""
    return records.select(F.explode("bases").alias("value")).filter(F.length("value") >= 8).select(F.lit("base").alias("attr"), "value").distinct()


def family_links(records: DataFrame) -> DataFrame:
    """links(attr 'name', a, b) of family names as far apart as compare_records lets
    them be: two edits from 7 letters on, for organisations from 5, else one."""
    near = radius_join(records.select(F.explode("cores").alias("value")), 2)
    orgs = records.filter("is_org").select(F.explode("cores").alias("a")).distinct().withColumn("org_a", F.lit(True))
    short = F.least(F.length("a"), F.length("b"))
    far = near.join(orgs, "a", "left").join(orgs.select(F.col("a").alias("b"), F.col("org_a").alias("org_b")), "b", "left")
    return far.filter((F.col("dist") <= 1) | (short >= 7) | ((short >= 5) & F.col("org_a") & F.col("org_b"))).select(F.lit("name").alias("attr"), "a", "b")


def pair_features(pairs: DataFrame, records: DataFrame, given: list[str], alias: list[tuple[str, str]]) -> DataFrame:
    """(a, b, mail, fit, x): the label, how the given names fit (ORGS for organisations), and the
    features in the order of FEATURES or ORG_FEATURES; pairs whose names exclude each other have fit -1."""
    names = records.select(F.explode("cores").alias("core"), "key").groupBy("core").agg(F.count("*").alias("n"))
    weights = records.select("key", F.explode("cores").alias("core")).join(names, "core").groupBy("key").agg(F.min("n").alias("common"))
    full = records.join(weights, "key", "left")
    side = lambda p: full.select(*[F.col(c).alias(p if c == "key" else f"{p}_{c}") for c in full.columns if c not in ("kind", "name")])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    sent = records.sparkSession.sparkContext.broadcast((given, alias))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(*sent.value)
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                fit, mail, x = compare_records(r, lexicon)
                rows.append((r.a, r.b, mail, fit, x))
            yield pd.DataFrame(rows, columns=["a", "b", "mail", "fit", "x"])

    return both.repartition(shuffle_partitions(records.sparkSession), "a", "b").mapInPandas(compare, "a string, b string, mail int, fit int, x array<double>")


def compare_records(r, lexicon: Lexicon) -> tuple[int, int, list[float]]:
    """(fit, label, features) of two records side by side. The label is 1 for persons with a
    shared e-mail address; for organisations it tells whether their sites are one, -1 if either has none."""
    from .editmetric import levenshtein, within

    mail = int(bool(set(r.a_emails) & set(r.b_emails)))
    ca, cb = set(r.a_cores), set(r.b_cores)
    if r.a_is_org or r.b_is_org:
        near = any(max(len(p), len(q)) >= 5 and within(p, q, 2 if min(len(p), len(q)) >= 5 else 1) for p in ca for q in cb)
        if not (r.a_is_org and r.b_is_org and (near or ca & cb)):
            return -1, 0, [0.0] * len(ORG_FEATURES)
        kinds = bool(r.a_org_kind and r.b_org_kind)
        city = r.a_city >= 0 and r.b_city >= 0
        land = isinstance(r.a_land, str) and isinstance(r.b_land, str) and r.a_land != r.b_land
        sites = isinstance(r.a_site, str) and isinstance(r.b_site, str)
        x = (
            1, bool(ca & cb), near and not ca & cb, kinds and r.a_org_kind == r.b_org_kind, kinds and bool(set(r.a_org_kind.split()) ^ set(r.b_org_kind.split())),
            city and r.a_city == r.b_city, city and r.a_city != r.b_city, land, bool(set(r.a_bases) & set(r.b_bases)),
        )
        return ORGS, int(r.a_site == r.b_site) if sites else -1, [float(v) for v in x]
    same = bool(ca & cb)
    slip = not same and any(min(len(p), len(q)) >= 5 and within(p, q, 2 if min(len(p), len(q)) >= 7 else 1) for p in ca for q in cb)
    fit = given_fit(list(r.a_givens), list(r.b_givens), lexicon)
    missing = not ca or not cb
    if not missing and not same and not slip:
        fit = -1
    account = bool(set(r.a_accounts) & set(r.b_accounts))
    shared = set(r.a_bases) & set(r.b_bases)
    if not shared:
        shared = {p for p in r.a_bases for q in r.b_bases if min(len(p), len(q)) >= 8 and levenshtein(p, q, 1) <= 1}
    if fit == -1 and (same or slip) and (mail or account or shared):
        fit = 0  # one account under another given name: a nickname not learned
    parts = ca | cb
    named = {s for s in shared if any(len(c) >= 4 and (c in _alike(s)) for c in parts)}
    city = r.a_city >= 0 and r.b_city >= 0
    heads = set(r.a_heads) & set(r.b_heads)
    common = np.log1p(max(0.0, min(_n(r.a_common), _n(r.b_common)) - 1))
    x = {
        "one": 1.0, "account": account, "base_own": bool(shared - named), "base_name": bool(named), "city_same": city and r.a_city == r.b_city,
        "city_other": city and r.a_city != r.b_city, "land_other": bool(isinstance(r.a_land, str) and isinstance(r.b_land, str) and r.a_land != r.b_land),
        "head_same": bool(heads), "head_other": bool(len(r.a_heads) and len(r.b_heads) and not heads), "given_same": fit == 3, "given_alias": fit == 2, "given_initial": fit == 1,
        "given_none": fit == 0, "slip": slip, "no_name": missing, "common": common / 3.0, "land_same": bool(isinstance(r.a_land, str) and r.a_land == r.b_land and not city),
    }
    x["nothing"] = not (account or shared or x["city_same"] or heads)
    return fit, mail, [float(x[f]) for f in FEATURES]


def _n(value) -> float:
    return float(value) if value is not None and value == value else 1.0


def _alike(handle: str) -> str:
    from .editmetric import skeleton

    return skeleton(handle)


#: Weights to which the ridge holds where labels tell little, in the order of FEATURES and of ORG_FEATURES.
PRIOR = (-1.0, 5.0, 5.0, 2.0, 3.0, -4.0, -2.5, 2.5, -2.0, 1.0, 0.5, 0.0, 0.0, -0.5, -1.0, -1.0, -0.5, 1.0)
ORG_PRIOR = (-2.0, 5.0, 4.5, 1.0, -7.0, 2.0, -7.0, -2.0, 2.0)
#: Strength of the ridge.
RIDGE = 3.0

#: Weights, slope and shift of the calibration.
Model = tuple[np.ndarray, float, float]


def fit_model(x: np.ndarray, y: np.ndarray, part: np.ndarray, prior: tuple[float, ...]) -> Model:
    """A logistic classifier and its calibration, the same way for any number of labels:
    a ridge draws the weights to the prior ones and the calibration to none, so that few
    labels move them little and none leave them. Labels of part 0 calibrate, those of
    part 1 are held out altogether, the others give the weights."""
    base = np.array(prior)
    if not len(y):
        return base, 1.0, 0.0
    learn, hold = part >= 2, part == 0
    w = base + _fit_from(x[learn], y[learn], x[learn] @ base, RIDGE)
    score = x[hold] @ w
    slope, shift = np.array([1.0, 0.0]) + _fit_from(np.stack([score, np.ones(len(score))], axis=1), y[hold], score, RIDGE)
    return w, float(max(slope, 0.1)), float(shift)


def weak_labels(features: DataFrame, known: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features, labels, parts) of pairs of persons and of pairs of organisations.

    A profile whose personal e-mail address is a person's labels its pairs: that
    person is right, other persons of fitting names are wrong unless known(a, b)
    ties them to the right one. Two organisations are labelled by their sites.
    Neither the address nor the site is a feature. At most LABELLED pairs of
    each kind are used, chosen by hash; so is the part of a label, 0 to 4, by
    the profile, so that no profile is in two parts.
    """
    usable = features.filter("fit between 0 and 3 and a like 'github:%' and b like 'person:%'")
    right = usable.filter("mail = 1").select("a", F.col("b").alias("right")).distinct()
    labelled = usable.join(right.select("a").distinct(), "a")
    excused = right.join(known, F.col("right") == F.col("k_a")).select("a", F.col("k_b").alias("b")).distinct().withColumn("excused", F.lit(1))
    labelled = labelled.join(excused, ["a", "b"], "left").filter("mail = 1 or excused is null")
    out = []
    for rows, width in ((labelled, len(FEATURES)), (features.filter(f"fit = {ORGS} and mail >= 0"), len(ORG_FEATURES))):
        found = rows.select("a", "mail", "x").orderBy(F.xxhash64("a", "b"), "a", "b").limit(LABELLED).collect()
        out.append((np.array([r["x"] for r in found]).reshape(-1, width), np.array([float(r["mail"]) for r in found]), np.array([hash_of(r["a"]) % 5 for r in found], dtype=int)))
    return out[0], out[1]


def fit_on_weak_labels(features: DataFrame, known: DataFrame) -> tuple[Model, Model]:
    """The classifiers of two persons and of two organisations."""
    persons, orgs = weak_labels(features, known)
    return fit_model(*persons, PRIOR), fit_model(*orgs, ORG_PRIOR)


def reliability(x: np.ndarray, y: np.ndarray, part: np.ndarray, prior: tuple[float, ...], bins: int = 5) -> list[tuple[float, int, float, float, float]]:
    """(from, n, mean probability, share right, mean squared error) of the labels held out, by probability."""
    w, slope, shift = fit_model(x, y, part, prior)
    held = part == 1
    p = 1 / (1 + np.exp(-np.clip(slope * (x[held] @ w) + shift, -30, 30)))
    at = np.minimum((p * bins).astype(int), bins - 1)
    return [(k / bins, int((at == k).sum()), float(p[at == k].mean()), float(y[held][at == k].mean()), float(((p - y[held])[at == k] ** 2).mean())) for k in range(bins) if (at == k).any()]


def _fit_from(x: np.ndarray, y: np.ndarray, base: np.ndarray, ridge: float) -> np.ndarray:
    """What to add to the weights that gave the scores `base`, by Newton's method with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(base + x @ w, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * s[:, None]).T @ x + ridge * np.eye(x.shape[1]), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def hash_of(text: str) -> int:
    """A hash that does not change from run to run."""
    import zlib

    return zlib.crc32(text.encode())


def score_pairs(features: DataFrame, models: tuple[Model, Model]) -> DataFrame:
    """(a, b, probability) of each pair that names do not exclude; a shared personal
    e-mail address adds MAIL_ODDS to the calibrated log odds."""

    def odds(model: Model) -> Column:
        w, slope, shift = model
        return reduce(lambda s, i: s + F.get("x", F.lit(i)) * F.lit(float(w[i])), range(len(w)), F.lit(0.0)) * F.lit(slope) + F.lit(shift)

    mailed = F.when(F.col("mail") == 1, F.lit(MAIL_ODDS)).otherwise(0.0)
    score = F.when(F.col("fit") == ORGS, odds(models[1])).otherwise(odds(models[0]) + mailed)
    alike = (F.col("fit") >= 0) | ((F.col("mail") == 1) & (F.col("fit") > -2) & (F.get("x", F.lit(FEATURES.index("no_name"))) == 1))
    return features.filter(alike).select("a", "b", (1 / (1 + F.exp(-score))).alias("probability"))


def entities(links: DataFrame) -> DataFrame:
    """(key, entity): connected components of links(a, b) by least labels that
    travel along the links and, each round, along themselves."""
    edges = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(edges.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("entity")))
    while True:
        heard = edges.join(label.select(F.col("key").alias("b"), "entity"), "b").groupBy(F.col("a").alias("key")).agg(F.min("entity").alias("heard"))
        jump = label.select(F.col("key").alias("entity"), F.col("entity").alias("jumped"))
        new = label.join(heard, "key").join(jump, "entity").select("key", F.least("entity", "heard", "jumped").alias("next"), "entity")
        new = cut(new)
        changed = new.filter("next <> entity").count()
        label = new.select("key", F.col("next").alias("entity"))
        if not changed:
            return label
