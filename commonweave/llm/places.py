"""Mapping freely typed values to a canonical list (problem 2), here places.

The entries of the list, under all their names, hang in BK-trees under a true
edit metric. A typed value is cut into segments, decorations are taken
off, and each reading is looked up within a radius that grows with its length;
the triangle inequality prunes the trees and no entry within the radius is
missed. A list of at most TREE_ENTRIES names is broadcast; a longer one is
sharded, each shard searched by blocks of distinct values, and the winners of
the shards merged by the very rank that decides within one list, so that both
ways give the same answers. Names of countries and the countries of time zones
are inputs beside the list.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .editmetric import BkTree, fold, undouble

#: Names up to which the whole list is sent to every worker, and that one shard of a longer list holds.
TREE_ENTRIES = 50_000
#: Distinct values searched against one shard at a time; different countries that a list may name.
BLOCK_VALUES, COUNTRIES = 200_000, 10_000
#: Values and readings remembered by one worker.
MEMO_VALUES = 200_000
#: How far an answer is from what was typed: edits; not in the country named in the text; not in that
#: beside it; not in that of the time zone; place of the reading in the text; the entry.
RANK = "edits int, said_off boolean, beside_off boolean, zone_off boolean, place int, entry_id long"

#: Words around a place that are no part of its name; fixed values.
BEFORE = re.compile(
    r"^(?:(?:currently|now|mostly|usually|originally|based|living|lives|live|located|working|born|residing|home|out|somewhere|just|right)\s+|"
    r"(?:in|near|at|from|outside|around|of|by|to|close to|next to|north of|south of|east of|west of|the|greater|metro|metropolitan|city of|town of|municipality of|area of|region of|county of|suburbs of|outskirts of|downtown|central|inner|bei|nahe|cerca de|pres de|environs de|raum|gross|ciudad de|ville de|stadt)\s+|\d[\d-]{2,}\s+)+"
)
AFTER = re.compile(
    r"(?:\s+(?:metropolitan area|metro area|bay area|area|metro|region|county|district|province|suburbs|surroundings|and surroundings|and environs|city|downtown|municipality|umgebung|und umgebung|et environs|y alrededores|online|remote|hybrid|\d[\d-]{3,}))+$"
)
_CUT = re.compile(r"[,;|/>()\[\]{}·•→⇒<\n\r\t–—]+|\s-\s|\s-|-\s|\s\+\s|\s&\s|…")
_JUNK = re.compile(r"[^\w\s.'’-]|_", re.UNICODE)
_SPACE = re.compile(r"\s+")


def radius(length: int, country_known: bool = False) -> int:
    """Edits (an exchange of two letters counts as one) allowed to so many letters."""
    if length < 5:
        return 0
    return 2 if length >= 8 or (length >= 6 and country_known) else 1


@dataclass(frozen=True)
class Hints:
    """Further names of countries (name: country) and the country of each time zone, all folded."""

    country_names: Mapping[str, str] = field(default_factory=dict)
    zone_country: Mapping[str, str] = field(default_factory=dict)


@dataclass
class PlaceList:
    """The canonical entries by folded name, and their trees."""

    names: dict[str, list[tuple[int, str]]] = field(default_factory=dict)
    tails: dict[str, set[str]] = field(default_factory=dict)
    countries: dict[str, str] = field(default_factory=dict)
    zones: Mapping[str, str] = field(default_factory=dict)
    near: dict[tuple[str, int], list[tuple[int, str]]] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: Collection[tuple[int, str, str | None, str | None]], hints: Hints = Hints(), lands: Collection[str] = ()) -> PlaceList:
        """From (id, name, country, further name); entries without name are left out.
        lands: countries of entries that are in other shards."""
        out = cls(zones=hints.zone_country)
        out.countries.update((land, land) for land in lands)
        for entry_id, name, country, other in rows:
            land = _plain(country or "")
            if land:
                out.countries[land] = land
            for n in (name, other):
                if n and _plain(n):
                    out.names.setdefault(_plain(n), []).append((entry_id, land))
        for name in out.names:
            first, _, rest = name.partition(" ")
            if rest:
                out.tails.setdefault(rest, set()).add(first)
        out.countries.update(hints.country_names)
        out.tree = BkTree(out.names)
        return out

    def within(self, reading: str, radius: int) -> list[tuple[int, str]]:
        """The names within radius of a reading; readings come again more often than whole values."""
        if (found := self.near.get((reading, radius))) is None:
            if len(self.near) > MEMO_VALUES:
                self.near.clear()
            found = self.near[reading, radius] = self.tree.within(reading, radius)
        return found


def _plain(text: str) -> str:
    """Folded, without signs but for inner dots and hyphens as blanks."""
    text = _JUNK.sub(" ", fold(text)).replace("’", "'")
    return _SPACE.sub(" ", text.replace("-", " ")).strip(" .'")


def _country(text: str, countries: Mapping[str, str]) -> str | None:
    return countries.get(text) or countries.get(text.replace(".", "").strip())


def _shortens(short: str, word: str) -> bool:
    """Is short made of letters of word in their order, from the first on?"""
    left = iter(word)
    return bool(short) and short[0] == word[0] and all(c in left for c in short)


def _readings(segment: str, places: PlaceList) -> list[str]:
    """The ways in which a segment may name a place, plainest first."""
    if re.fullmatch(r"\w( \w){3,}", segment):
        segment = segment.replace(" ", "")
    out = [segment]
    bare = BEFORE.sub("", segment)
    bare = AFTER.sub("", bare)
    bare = BEFORE.sub("", bare)
    if bare != segment and bare:
        out.append(bare)
    for s in list(out):
        first, _, rest = s.partition(" ")
        out += [f"{word} {rest}" for word in sorted(places.tails.get(rest, ())) if _shortens(first.strip("."), word)]
    out += [u for s in list(out) if (u := undouble(s)) != s]
    return out


def _segments(text: str, countries: Mapping[str, str]) -> tuple[str | None, list[str], str]:
    """(country named as a segment of its own, the other segments, the whole text folded)."""
    spaced = re.sub(r"(?<=\w)\.(?=\s|$)", " ", text) if not re.search(r"\b\w\.\w\.", text) else text
    said, left = None, []
    for s in (p for p in (_plain(s) for s in _CUT.split(spaced)) if p):
        if land := _country(s, countries):
            said = said or land
        else:
            left.append(s)
    return said, left, _plain(_CUT.sub(" ", spaced))


def _without_country(segment: str, countries: Mapping[str, str]) -> tuple[str, str] | None:
    """(country, rest) of a segment that ends with a country, or starts with one of several words."""
    words = segment.split(" ")
    for n in (4, 3, 2, 1):
        if len(words) > n and (land := _country(" ".join(words[-n:]), countries)):
            return land, " ".join(words[:-n])
        if len(words) > n and n > 1 and (land := _country(" ".join(words[:n]), countries)):
            return land, " ".join(words[n:])
    return None


def doubtful_segments(text: str, countries: Mapping[str, str]) -> list[str]:
    """Segments that are a name of the list or a name with a country: only the list can tell."""
    return [s for s in _segments(text, countries)[1] if _without_country(s, countries)]


def find_place(text: str, country: str | None, zone: str | None, places: PlaceList, listed: Collection[str] | None = None) -> tuple | None:
    """The answer of least RANK, or None: the entry that the typed text means.

    Exact names come before names with edits, and among equals those in the
    country named in the text or beside it; then the country of the time zone,
    then the least id decides. Names with edits are taken only where no named
    country contradicts them. listed: those of the doubtful segments that are
    names of the whole list, where `places` is only a shard of it.
    """
    said, left, whole = _segments(text, places.countries)
    named = places.names if listed is None else listed
    for i, s in enumerate(left):
        if s not in named and (cut := _without_country(s, places.countries)):
            said, left[i] = said or cut[0], cut[1]
    beside = _country(_plain(country), places.countries) if country else None
    own = places.zones.get(zone or "")
    joined = [f"{b} {a}" for a, b in zip(left, left[1:])] + [f"{a} {b}" for a, b in zip(left, left[1:])]
    tries = [(r, k) for k, s in enumerate([*left, *joined, whole]) for r in _readings(s, places)]
    exact = [
        (0, bool(said) and land != said, bool(beside) and land != beside, land != own, k, entry_id)
        for reading, k in tries
        for entry_id, land in places.names.get(reading, ())
    ]
    if exact:
        return min(exact)
    near = []
    for reading, k in tries:
        if r := radius(len(reading), bool(said or beside)):
            for edits, name in places.within(reading, r):
                for entry_id, land in places.names[name]:
                    if not (said and land != said) and (said or not beside or land == beside):
                        near.append((edits, False, bool(beside) and land != beside, land != own, k, entry_id))
    return min(near, default=None)


def map_places(values: DataFrame, entries: DataFrame, hints: Hints = Hints(), tree_entries: int = TREE_ENTRIES, block_values: int = BLOCK_VALUES) -> DataFrame:
    """Adds entry_id and edits to values(key..., text, country, zone).

    entries has (entry_id long, name, country, other). Every row with a text
    that is not null or blank comes out, with entry_id -1 where no entry is
    meant; other rows do not. Repeated rows are kept, other columns too. The
    number of shards and of blocks follows from the numbers of names and of
    distinct values.
    """
    values = values.filter(F.length(F.trim(F.regexp_replace("text", r"\s+", " "))) > 0)
    listed = entries.filter("name is not null").select("entry_id", "name", "country", "other")
    if listed.limit(tree_entries + 1).count() > tree_entries:
        return _map_by_shards(values, listed, hints, tree_entries, block_values)
    sent = values.sparkSession.sparkContext.broadcast([tuple(r) for r in listed.collect()])  # at most tree_entries rows

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, memo = PlaceList.of(sent.value, hints), {}
        for pdf in batches:
            ids, edits = [], []
            for key in zip(pdf["text"], pdf["country"], pdf["zone"]):
                if key not in memo:
                    if len(memo) > MEMO_VALUES:
                        memo.clear()
                    memo[key] = find_place(*key, places) or (0, -1)
                ids.append(memo[key][-1])
                edits.append(memo[key][0])
            yield pdf.assign(entry_id=ids, edits=edits)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in values.schema) + ", entry_id long, edits int"
    return values.mapInPandas(look_up, schema)


def _map_by_shards(values: DataFrame, listed: DataFrame, hints: Hints, tree_entries: int, block_values: int) -> DataFrame:
    """map_places over a list that no worker holds whole: each shard of it against each block of the distinct values."""
    spark = values.sparkSession
    lands = [_plain(r[0]) for r in listed.select("country").dropna().distinct().limit(COUNTRIES + 1).collect()]
    if len(lands) > COUNTRIES:
        raise ValueError("more countries than the workers are meant to hold")
    names = cut(listed.withColumn("h", F.xxhash64("name", "country", "other")))
    distinct = cut(values.select("text", "country", "zone").distinct())
    shards, blocks = 1 + names.count() // tree_entries, 1 + distinct.count() // block_values

    def doubts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        countries = PlaceList.of((), hints, lands).countries
        for pdf in batches:
            found = [doubtful_segments(t, countries) for t in pdf["text"]]
            yield pd.DataFrame({"text": pdf["text"].repeat([len(f) for f in found]), "name": [s for f in found for s in f]})

    def plain_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"name": [p for n in (*pdf["name"], *pdf["other"]) if n and (p := _plain(n))]})

    known = names.select("name", "other").mapInPandas(plain_names, "name string").distinct()
    sure = distinct.select("text").distinct().mapInPandas(doubts, "text string, name string").join(known, "name", "left_semi")
    asked = distinct.join(sure.groupBy("text").agg(F.collect_set("name").alias("listed")), "text", "left")
    left = asked.withColumn("b", F.pmod(F.xxhash64("text", "country", "zone"), F.lit(blocks)).cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = names.withColumn("s", F.pmod("h", F.lit(shards)).cast("int")).drop("h").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(values_pdf: pd.DataFrame, entries_pdf: pd.DataFrame) -> pd.DataFrame:
        bare = lambda pdf: pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None)
        places = PlaceList.of(list(bare(entries_pdf[["entry_id", "name", "country", "other"]])), hints, lands)
        rows = []
        for text, country, zone, known in bare(values_pdf[["text", "country", "zone", "listed"]]):
            if found := find_place(text, country, zone, places, frozenset(known if known is not None else ())):
                rows.append((text, country, zone, *found))
        return pd.DataFrame(rows, columns=["text", "country", "zone", *[c.split(" ")[0] for c in RANK.split(", ")]])

    won = left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInPandas(search, f"text string, country string, zone string, {RANK}")
    rank = F.struct(*[c.split(" ")[0] for c in RANK.split(", ")])
    merged = won.groupBy("text", "country", "zone").agg(F.min(rank).alias("w"))
    merged = merged.select(F.col("text").alias("_t"), F.col("country").alias("_c"), F.col("zone").alias("_z"), F.col("w.entry_id").alias("_id"), F.col("w.edits").alias("_e"))
    on = F.col("text").eqNullSafe(F.col("_t")) & F.col("country").eqNullSafe(F.col("_c")) & F.col("zone").eqNullSafe(F.col("_z"))
    found = values.join(merged, on, "left")
    return found.withColumn("entry_id", F.coalesce("_id", F.lit(-1).cast("long"))).withColumn("edits", F.coalesce("_e", F.lit(0))).drop("_t", "_c", "_z", "_id", "_e")
