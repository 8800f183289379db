"""Identity resolution of incoming records against stored persons.

The batch contract: all incoming records are resolved against one snapshot of
persons; then records that create persons are collapsed among themselves by
shared addresses and accounts, one new person for each component.

Candidates come from equi-joins on blocking values only (addresses, accounts,
handles named in a biography, the city or employer beside a name, beginnings of words),
so no pair is made that shares nothing; names are then compared by Jaro-Winkler, within the
worker that holds a block, so that only the best of them are ever written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.similarity import best_jaro_winkler, letter_codes
from ..functions.text import FREE_MAIL, email_domain, normalize_name
from ..session import cut, shuffle_partitions
from .likest import alike_of_cells, in_cells, likest_in_blocks

#: Weight of each kind of evidence; fixed values.
WEIGHTS = {
    "name_exact": 0.4, "name_fuzzy": 0.2, "email_exact": 0.95, "email_domain": 0.6, "github_link_in_bio": 0.85, "twitter_link_in_bio": 0.85, "linkedin_link_in_bio": 0.85,
    "employer_match": 0.3, "city_match": 0.2, "timezone_overlap": 0.1, "mutual_connection": 0.25, "event_co_attendance": 0.15,
}
#: Confidence from which a record is merged, or reviewed; least similarity of a name block and of fuzzy evidence.
MERGE, REVIEW, BLOCK, FUZZY = 0.85, 0.65, 0.8, 0.85
#: Platforms whose handles a biography names.
BIO = ("github", "twitter", "linkedin")
#: Candidates kept for each record, by the kind of block and the likeness of names.
MOST_CANDIDATES = 20


def _norm(names: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.lower(F.trim(F.regexp_replace(n, r"\s+", " ")))), lambda n: n != ""))


def prepare(df: DataFrame, key: str) -> DataFrame:
    """Records or persons in comparable form. Columns: key, names, emails, city, country,
    timezone, employer, accounts ('platform:handle'), github, twitter, linkedin (handles
    named in a biography; null for persons), event_ids, connected_ids."""
    text = lambda c: F.nullif(F.lower(F.trim(F.col(c))), F.lit(""))
    arr = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    handle = lambda c: F.nullif(F.regexp_replace(F.lower(F.trim(F.col(c))), "^@", ""), F.lit(""))
    plain = df.withColumn("_names", F.array_join(F.transform(_norm(F.col("names")), lambda n: n), "\u0001"))
    plain = plain.withColumn("_names", F.filter(F.split(normalize_name("_names"), "\u0001"), lambda n: n != ""))
    emails = F.array_distinct(F.filter(F.transform(arr("emails"), lambda e: F.lower(F.trim(e))), lambda e: e.contains("@")))
    return plain.select(
        F.col(key).alias("key"), F.col("_names").alias("names"), emails.alias("emails"), text("city").alias("city"), text("country").alias("country"), F.col("timezone"), F.col("employer"),
        F.transform(arr("accounts"), lambda a: F.regexp_replace(F.lower(F.trim(a)), ":@", ":")).alias("accounts"), handle("github").alias("github"), handle("twitter").alias("twitter"), handle("linkedin").alias("linkedin"),
        arr("event_ids").alias("event_ids"), arr("connected_ids").alias("connected_ids"),
    )


def _blocks(df: DataFrame, bio: bool) -> DataFrame:
    """(key, priority, value) of each value that ties by itself: 1 addresses, 2 accounts, 3 handles in the biography."""
    own = F.transform("emails", lambda e: F.struct(F.lit(1).alias("priority"), F.concat(F.lit("e:"), e).alias("value")))
    accounts = F.transform("accounts", lambda a: F.struct(F.lit(2).alias("priority"), F.concat(F.lit("a:"), a).alias("value")))
    named = F.array_compact(F.array(*[F.when(F.col(p).isNotNull(), F.struct(F.lit(3).alias("priority"), F.concat(F.lit(f"a:{p}:"), F.col(p)).alias("value"))) for p in BIO]))
    parts = [own, accounts, named] if bio else [own, accounts]
    return df.select("key", F.explode(F.array_distinct(F.concat(*parts))).alias("b")).select("key", "b.priority", "b.value")


def _name_blocks(df: DataFrame, bio: bool) -> DataFrame:
    """(value, key, names) of each block in which names are compared. A record with a city or employer needs one of
    them to agree, so those alone bring its names together with the names of persons there, and none is missed; a record
    without either meets persons by a word of three letters or more that begins alike."""
    ends = F.array_compact(F.array(F.concat(F.lit("c:"), F.col("city")), F.concat(F.lit("o:"), F.col("employer"))))
    words = F.array_distinct(F.transform(F.filter(F.flatten(F.transform("names", lambda n: F.split(n, " "))), lambda w: F.length(w) >= 2), lambda w: F.concat(F.lit("n:"), F.substring(w, 1, 3))))
    values = F.when(F.size(ends) == 0, words).otherwise(ends) if bio else F.concat(ends, words)
    return df.filter(F.size("names") > 0).select(F.explode(values).alias("value"), "key", F.array_distinct("names").alias("names"))


def _proven(records: DataFrame, persons: DataFrame) -> DataFrame:
    """(record, person, priority, proofs) of those that share an address, an account or a handle in the
    biography; proofs are the kinds of evidence that this is."""
    left = _blocks(records, True).select(F.col("key").alias("record"), "priority", "value")
    right = _blocks(persons, False).select(F.col("key").alias("person"), "value")
    kind = F.when(F.col("priority") == 1, "email_exact").when(F.col("priority") == 3, F.concat(F.split_part("value", F.lit(":"), F.lit(2)), F.lit("_link_in_bio")))
    return left.join(right, "value").groupBy("record", "person").agg(F.min("priority").alias("priority"), F.collect_set(kind).alias("proofs"))


def _candidates(proven: DataFrame, r: DataFrame, p: DataFrame, most: int) -> DataFrame:
    """candidates() with their proofs, of records and persons that need not be computed again."""
    proven = proven.join(r.select(F.col("key").alias("record"), F.col("names").alias("rn")), "record").join(p.select(F.col("key").alias("person"), F.col("names").alias("pn")), "person")
    proven = proven.select("record", "person", "priority", best_jaro_winkler("rn", "pn").alias("likeness"), "proofs")
    near = likest_in_blocks(_name_blocks(r, True), _name_blocks(p, False), most, BLOCK)
    near = near.select("record", "person", F.lit(4).alias("priority"), "likeness", F.array().cast("array<string>").alias("proofs"))
    # those proven are the first anyway, so that the best `most` by names are enough beside them
    every = proven.unionByName(near).repartition(shuffle_partitions(r.sparkSession), "record")
    every = every.groupBy("record", "person").agg(F.min(F.struct("priority", "likeness", "proofs")).alias("m")).select("record", "person", "m.*")
    rank = F.row_number().over(Window.partitionBy("record").orderBy("priority", F.desc("likeness"), "person"))
    return every.withColumn("_k", rank).filter(F.col("_k") <= most).drop("_k")


def candidates(records: DataFrame, persons: DataFrame, most: int = MOST_CANDIDATES) -> DataFrame:
    """(record, person, priority, likeness) of at most `most` persons for each record.
    Name blocks need likeness 0.8 and, where the record has a city or employer, that one of them agrees."""
    slim = [cut(df.select("key", "names", "city", "employer")) for df in (records, persons)]
    return _candidates(_proven(records, persons), *slim, most).drop("proofs")


#: Letters by how common they are, so that each group gets as many, and the slots that hold them and all others.
LETTERS, SLOTS = "aeinrolstmhdcukgbypjvwfzxq0123456789", 64
#: What rounding may take from a bound.
ROUNDING = 1e-6


def alike_words(left: DataFrame, right: DataFrame, least: float = 0.95, whole: bool = False) -> DataFrame:
    """(a, b, s): all distinct words of left(value) and right(value) of Jaro-Winkler similarity `least`, 0.95 or
    more; whole as in jaro().

    With p letters of a common beginning, la and lb letters, m of them in common and t moved, `least` says
    (1 - m/la) + (1 - m/lb) + t/m <= 3 (1 - least) / (1 - p/10), so at most that share of the longer word's letters
    is without a partner on either side. Words meet that begin with the same three letters; and, for p up to 2, the
    alphabet is cut into more groups than there can be such letters, and words meet that have the same
    letters, in any order, in one group. So no pair is lost. What meets is compared within one worker."""
    signed = [_signed_words(cut(words.filter("length(value) > 0").select("value").distinct()), 3 * (1 - least) / 0.8) for words in (left, right)]
    return in_cells(*signed, lambda cells: alike_of_cells(cells, least, whole), ("a", "b", "s")).distinct()


def _signed_words(words: DataFrame, room: float) -> DataFrame:
    """(value, key '', names) of each key by which alike_words() lets words(value) meet. A key holds how many letters
    the longer word of a pair may have without a partner, at the share `room`; a word has those of all its partners' lengths."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = np.random.default_rng(20240517).integers(1, 1 << 63, SLOTS, dtype=np.uint64)
        slot_of = {ord(c): k for k, c in enumerate(LETTERS)}
        allowed = lambda n: np.floor(n * room + ROUNDING).astype(int)
        for pdf in batches:
            values = list(pdf["value"])
            if not values:
                continue
            codes, length = letter_codes(values), np.array([len(v) for v in values])
            kinds, at = np.unique(codes, return_inverse=True)
            slots = np.array([slot_of.get(int(c), len(LETTERS) + int(c) % (SLOTS - len(LETTERS))) for c in kinds])[at.reshape(codes.shape)]
            rows, count = np.arange(len(values)), np.zeros((len(values), SLOTS), dtype=np.uint64)
            for j in range(codes.shape[1]):
                count[rows, slots[:, j]] += (length > j).astype(np.uint64)
            owners = [rows[length >= 3]]
            keys = [np.array([zlib.crc32(v[:3].encode()) for v in values if len(v) >= 3], dtype=np.int64)]
            low, high = allowed(length), allowed(np.floor(length / (1 - room) + ROUNDING))
            for u in range(int(low.min()), int(high.max()) + 1):
                r = rows[(low <= u) & (u <= high)]
                for g in range(min(u + 1, SLOTS) if len(r) else 0):
                    # the sum of the weights of its letters stands for what a word has in a group
                    had = (count[r, g :: u + 1] * weight[g :: u + 1]).sum(axis=1, dtype=np.uint64)
                    keys.append((had ^ np.uint64(zlib.crc32(f"{u} {g}".encode()) << 31)).astype(np.int64))
                    owners.append(r)
            yield pd.DataFrame({"value": np.concatenate(keys), "word": pdf["value"].to_numpy()[np.concatenate(owners)]})

    return words.mapInPandas(sign, "value long, word string").select("value", F.lit("").alias("key"), F.array("word").alias("names"))


def signals(pairs: DataFrame, records: DataFrame, persons: DataFrame) -> DataFrame:
    """pairs with `signals`: an array of (kind, weight, confidence), only the kinds that fire. Where pairs have
    `proofs` and their true likeness, as of _candidates(), the persons' names, addresses and accounts are not moved."""
    given = "proofs" in pairs.columns
    domains = lambda e: F.array_distinct(F.filter(F.transform(e, email_domain), lambda d: (d != "") & ~d.isin(list(FREE_MAIL))))
    persons = persons.withColumn("domains", domains("emails"))
    if given:
        persons = persons.drop("names", "emails", "accounts", "github", "twitter", "linkedin")
    both = pairs.join(persons.alias("p"), F.col("person") == F.col("p.key")).join(records.withColumn("domains", domains("emails")).alias("r"), F.col("record") == F.col("r.key"))
    r, p = (lambda c: F.col(f"r.{c}")), (lambda c: F.col(f"p.{c}"))
    # only equal names have likeness 1
    exact = F.col("likeness") == 1 if given else F.arrays_overlap(r("names"), p("names"))
    fuzzy = F.when(~exact & (F.col("likeness") >= FUZZY), F.greatest(F.lit(0.5), (F.col("likeness") - FUZZY) / (1 - FUZZY)))
    name = F.when(exact, F.lit(1.0)).otherwise(fuzzy)
    proof = lambda kind, otherwise: F.when(F.array_contains("proofs", kind) if given else otherwise(), F.lit(1.0))
    known = lambda platform: proof(f"{platform}_link_in_bio", lambda: r(platform).isNotNull() & F.array_contains(p("accounts"), F.concat(F.lit(f"{platform}:"), r(platform))))
    mutual = F.size(F.array_intersect(r("connected_ids"), p("connected_ids")))
    shared = F.size(F.array_intersect(r("event_ids"), p("event_ids")))
    countries = F.coalesce(r("country") == p("country"), F.lit(True))
    zone = lambda z: F.split_part(z, F.lit("/"), F.lit(1))
    found = {
        "name_exact": F.when(exact, F.lit(1.0)), "name_fuzzy": fuzzy, "email_exact": proof("email_exact", lambda: F.arrays_overlap(r("emails"), p("emails"))),
        "email_domain": F.when(F.arrays_overlap(r("domains"), p("domains")), name), "github_link_in_bio": known("github"), "twitter_link_in_bio": known("twitter"), "linkedin_link_in_bio": known("linkedin"),
        "employer_match": F.when(r("employer") == p("employer"), F.lit(1.0)), "city_match": F.when((r("city") == p("city")) & countries, F.lit(1.0)),
        "timezone_overlap": F.when(r("timezone") == p("timezone"), F.lit(1.0)).when(zone(r("timezone")) == zone(p("timezone")), F.lit(0.5)),
        "mutual_connection": F.when(mutual > 0, F.greatest(F.lit(0.5), F.least(F.lit(1.0), mutual / 3.0))), "event_co_attendance": F.when(shared > 0, F.least(F.lit(1.0), shared / 2.0)),
    }
    each = [F.when(c.isNotNull(), F.struct(F.lit(k).alias("kind"), F.lit(WEIGHTS[k]).alias("weight"), c.cast("double").alias("confidence"))) for k, c in found.items()]
    return both.select("record", "person", "priority", "likeness", F.array_compact(F.array(*each)).alias("signals"))


def confidence(found: Column) -> Column:
    """The weighted mean of the signals, and from two kinds on 0.03 for each kind, 0.15 at most; 1 at most."""
    total = lambda f: F.aggregate(found, F.lit(0.0), lambda s, x: s + f(x))
    mean = F.coalesce(F.try_divide(total(lambda x: x["weight"] * x["confidence"]), total(lambda x: x["weight"])), F.lit(0.0))
    boost = F.when(F.size(found) >= 2, F.least(F.lit(0.15), F.size(found) * 0.03)).otherwise(0.0)
    return F.least(F.lit(1.0), mean + boost)


def reasoning(found: Column) -> Column:
    """The three strongest signals as text."""
    ordered = F.reverse(F.array_sort(F.transform(found, lambda x: F.struct((x["weight"] * x["confidence"]).alias("s"), x["kind"].alias("kind")))))
    return F.array_join(F.transform(F.slice(ordered, 1, 3), lambda x: F.format_string("%s (%.2f)", x["kind"], x["s"])), ", ")


def resolve(records: DataFrame, persons: DataFrame, require_identity_signal: bool = False) -> DataFrame:
    """(record, action, person, confidence, n_candidates, reasoning): one row for each record.

    A shared address, then a shared account, merges at once. Otherwise the best
    candidate decides: merge from 0.85 on, human_review from 0.65 on, else
    create_new without and skip with candidates that show any signal.
    require_identity_signal turns a merge without name, address or biography
    evidence into a review.
    """
    records, persons = cut(records), cut(persons)
    proven = cut(_proven(records, persons))
    first = proven.filter("priority < 3").groupBy("record").agg(F.min(F.struct("priority", "person"))["person"].alias("linked"))  # as explicit_links()
    scored = signals(_candidates(proven, records, persons, MOST_CANDIDATES), records, persons).filter(F.size("signals") > 0).withColumn("score", confidence(F.col("signals")))
    # at most MOST_CANDIDATES for each record
    best = scored.groupBy("record").agg(F.collect_list(F.struct("person", "score", "signals")).alias("l"), F.max("score").alias("m"))
    best = best.select("record", F.size("l").alias("n"), F.array_min(F.filter("l", lambda x: x["score"] == F.col("m"))).alias("b"))
    out = records.select(F.col("key").alias("record")).join(first, "record", "left").join(best, "record", "left")
    identity = F.exists("b.signals", lambda x: ~x["kind"].isin("employer_match", "city_match", "timezone_overlap", "mutual_connection", "event_co_attendance"))
    strong = F.col("b.score") >= MERGE
    action = (
        F.when(F.col("linked").isNotNull(), "merge").when(strong & (F.lit(not require_identity_signal) | identity), "merge")
        .when(F.col("b.score") >= REVIEW, "human_review").when(F.coalesce("n", F.lit(0)) > 0, "skip").otherwise("create_new")
    )
    return out.select(
        "record", action.alias("action"), F.coalesce("linked", F.when(action.isin("merge", "human_review"), F.col("b.person"))).alias("person"),
        F.when(F.col("linked").isNotNull(), 1.0).otherwise(F.floor(F.coalesce("b.score", F.lit(0.0)) * 100 + 0.5) / 100).alias("confidence"), F.coalesce("n", F.lit(0)).alias("n_candidates"),
        F.when(F.col("linked").isNotNull(), "explicit link").otherwise(F.coalesce(reasoning(F.col("b.signals")), F.lit(""))).alias("reasoning"),
    )


def collapse_new(records: DataFrame) -> DataFrame:
    """(record, entity): records to be created, those that share an address or account together.
    Least labels travel over the shared values until none changes."""
    values = cut(_blocks(records, False).filter("priority < 3").select(F.col("key").alias("record"), "value"))
    label = cut(records.select(F.col("key").alias("record"), F.col("key").alias("entity")))
    while True:
        by_value = values.join(label, "record").groupBy("value").agg(F.min("entity").alias("least"))
        heard = values.join(by_value, "value").groupBy("record").agg(F.min("least").alias("heard"))
        new = cut(label.join(heard, "record", "left").select("record", F.least("entity", F.coalesce("heard", "entity")).alias("next"), "entity"))
        changed = new.filter("next <> entity").limit(1).count()
        label = new.select("record", F.col("next").alias("entity"))
        if not changed:
            return label


def conflicts(resolved: DataFrame, records: DataFrame, persons: DataFrame) -> DataFrame:
    """(record, person, field, old, new) where a merged record disagrees on employer or city."""
    both = resolved.filter("action = 'merge'").join(records.alias("r"), F.col("record") == F.col("r.key")).join(persons.alias("p"), F.col("person") == F.col("p.key"))
    rows = F.array_compact(F.array(*[
        F.when(F.col(f"r.{f}") != F.col(f"p.{f}"), F.struct(F.lit(f).alias("field"), F.col(f"p.{f}").alias("old"), F.col(f"r.{f}").alias("new"))) for f in ("employer", "city")
    ]))
    return both.select("record", "person", F.explode(rows).alias("c")).select("record", "person", "c.*")


def apply_merges(resolved: DataFrame, records: DataFrame, persons: DataFrame) -> DataFrame:
    """persons with names, addresses and accounts of merged records appended, and empty city, country and time zone filled."""
    merged = resolved.filter("action = 'merge'").select("record", F.col("person").alias("key")).join(records.withColumnRenamed("key", "record"), "record")
    arrays, fills = ("names", "emails", "accounts", "event_ids", "connected_ids"), ("city", "country", "timezone", "employer")
    gathered = merged.groupBy("key").agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(f"_{c}") for c in arrays], *[F.min_by(c, F.struct(F.col(c).isNull(), "record")).alias(f"_{c}") for c in fills])
    joined = persons.join(gathered, "key", "left")
    empty = F.array().cast("array<string>")
    cols = [F.array_distinct(F.concat(F.col(c), F.coalesce(f"_{c}", empty))).alias(c) if c in arrays else F.coalesce(c, f"_{c}").alias(c) if c in fills else F.col(c) for c in persons.columns]
    return joined.select(*cols)


def explicit_links(records: DataFrame, persons: DataFrame) -> DataFrame:
    """(record, person, by): the person that a record's address, else its account, names; the least id of several."""
    kind = F.when(F.col("priority") == 1, "email").otherwise("account")
    left = _blocks(records, False).filter("priority < 3").select(F.col("key").alias("record"), "priority", "value")
    right = _blocks(persons, False).filter("priority < 3").select(F.col("key").alias("person"), "value")
    return left.join(right, "value").groupBy("record").agg(F.min(F.struct("priority", "person")).alias("m")).select("record", F.col("m.person").alias("person"), F.col("m.priority").alias("priority")).withColumn("by", kind).drop("priority")


def decision_log(resolved: DataFrame, at: Column) -> DataFrame:
    """One audit row for every record, whatever was decided, its confidence to two digits."""
    return resolved.select("record", "person", "action", F.round("confidence", 2).alias("confidence"), "reasoning", "n_candidates", at.alias("decided_at"))


def review_queue(resolved: DataFrame, scored: DataFrame, most: int = 3) -> DataFrame:
    """(record, reason, candidates): what a human has to look at, reviews and skips alike, with
    the best `most` candidates of scored(record, person, score)."""
    waiting = resolved.filter("action in ('human_review', 'skip')").select("record", F.col("action").alias("reason"))
    rank = F.row_number().over(Window.partitionBy("record").orderBy(F.desc("score"), "person"))
    best = scored.join(waiting, "record", "left_semi").withColumn("k", rank).filter(F.col("k") <= most)
    listed = best.groupBy("record").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "person", "score"))), lambda x: F.struct(x["person"].alias("person"), x["score"].alias("score"))).alias("candidates"))
    return waiting.join(listed, "record", "left")


def display_name(canonical: Column, seen: Column, handle: Column, email: Column) -> Column:
    """The name of a new person: the given one, else the first seen, the handle, the address, else 'unknown'."""
    real = lambda c: F.nullif(F.trim(c), F.lit(""))
    first = F.get(F.filter(F.coalesce(seen, F.array().cast("array<string>")), lambda n: F.length(F.trim(n)) > 0), F.lit(0))
    return F.coalesce(real(canonical), real(first), real(handle), real(email), F.lit("unknown"))


def new_persons(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """(id, canonical_name, names, emails, primary_email, accounts, city, country, timezone, employer): a person
    for each entity of the records to be created; lists joined, of single values the first record's."""
    made = records.join(resolved.filter("action = 'create_new'").select(F.col("record").alias("key")), "key", "left_semi")
    whole = made.join(collapse_new(made).withColumnRenamed("record", "key"), "key")
    lists, single = ("names", "emails", "accounts"), ("city", "country", "timezone", "employer")
    merged = whole.groupBy("entity").agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in lists], *[F.min_by(c, F.struct(F.col(c).isNull(), "key")).alias(c) for c in single])
    handle = F.substring_index(F.get("accounts", F.lit(0)), ":", -1)
    name = display_name(F.lit(None).cast("string"), F.col("names"), handle, F.get("emails", F.lit(0)))
    return merged.select(F.concat(F.lit("new:"), F.sha2("entity", 256)).alias("id"), name.alias("canonical_name"), "names", "emails", F.get("emails", F.lit(0)).alias("primary_email"), "accounts", *single)


def tier3_confidence(cosine: Column, found: Column) -> Column:
    """Embedding evidence: 0 below likeness 0.85 or without other evidence, else by likeness and the weighted evidence."""
    support = F.aggregate(found, F.lit(0.0), lambda s, x: s + x["weight"] * x["confidence"])
    return F.when((cosine < 0.85) | (F.size(found) == 0), 0.0).otherwise(F.least(F.lit(1.0), 0.5 + 0.3 * (cosine - 0.85) / 0.15 + 0.2 * F.least(F.lit(1.0), support)))


