"""Personal information inside free text (problem 6): finding it and putting
typed placeholders in its place.

E-mail addresses, phone numbers, identity numbers and street addresses have
forms of their own. A person's name has none, so it is judged by how much its
family-name term discloses, as in information-theoretic sanitisation: over the
whole corpus it is counted how often a term occurs and how often it stands in a
name slot (beside a given name or an initial). The slot, that is, that a person
is named, has the information content IC = -log2 p(slot); the pointwise mutual
information of term and slot says how many of these bits the term alone gives
away, and their ratio is the term's disclosure, at most 1. Terms above a
threshold are names; words that only happen to stand beside a given name
disclose little and stay, however they are written. Counts are smoothed, so that
a term seen once discloses less than one seen often. Which words are given names
is learned from a table of persons in the same way: a given name has far more
different partners than a family name.

Once names are known, disclosing_terms() asks the same of every other term with
the single protected persons in place of the slot: which terms of the texts
that name a person, alone or together with few others, give that person away.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread
from .editmetric import fold, skeleton

#: Share of the information of a name slot from which a term is a family name, and the occurrences that
#: smoothing adds to those of each term.
DISCLOSURE, SMOOTHING = 0.8, 0.5
#: The same share for a term and a person, and the texts in which both must stand.
PERSON_DISCLOSURE, PERSON_TEXTS = 0.8, 3
#: Share of all (word, partner) pairs from which a word is a given name, and the least number of partners.
GIVEN_SHARE, GIVEN_LEAST = 1.2e-4, 3
#: Share of its names in which a given name stands first.
GIVEN_LEADS = 0.4
#: Given names sent to the workers: as each has GIVEN_SHARE of all pairs, there cannot be more.
GIVEN_LIMIT = int(1 / GIVEN_SHARE) + 1

#: Letters of a family name at least: a single one is an initial.
LEAST_FAMILY = 2
#: Orders of a name: Given Family; Family Given; Family, Given.
PLAIN, TURNED, COMMA = 0, 1, 2
#: Titles and degrees beside names, fixed values.
TITLES = ("mr", "mrs", "ms", "miss", "mx", "dr", "prof", "ing", "dipl", "phd", "md", "msc", "bsc", "mba", "sir", "dame", "herr", "frau", "sr", "sra", "jr", "m", "mme")

_AT = r"(?:[@＠]|\s[@＠]\s|\s(?-i:AT)\s|\s?(?:\(at\)|\[at\]|\{at\}|<at>|&#64;|%40)\s?)"
_DOT = r"(?:\.|\s?(?:\(dot\)|\[dot\]|\{dot\}|<dot>)\s?|\sdot\s)"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_LOCAL = r"[A-Za-z0-9_%+](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+])?"
#: Last labels of addresses spelled in words, without those that are common words; fixed values.
_ENDINGS = "com|org|net|edu|gov|io|dev|ai|app|co|uk|de|fr|es|pl|se|jp|br|mx|ca|ke|eu|nl|ch|pt|ru|cn|info|biz|xyz|tech|cloud|example|test|invalid|local"
#: An address with a sign for the 'at', or with the word 'at' and a spelled dot.
EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+/@-])({_LOCAL}){_AT}{_LABEL}(?:{_DOT}{_LABEL})*?{_DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9-])(?!:[\w~/-]+/|:\w+$)", re.I)
EMAIL_WORDS = re.compile(
    rf"(?<![A-Za-z0-9._%+/@-])({_LOCAL})\sat\s{_LABEL}(?:{_DOT}{_LABEL})*?(?:\s?(?:\(dot\)|\[dot\]|\{{dot\}}|<dot>)\s?|\sdot\s)(?:{_ENDINGS})(?![A-Za-z0-9-])", re.I
)
#: Local parts of machine accounts, fixed values.
MACHINES = frozenset("git svn hg ssh root deploy www noreply no-reply donotreply mailer-daemon postmaster".split())
PHONE = re.compile(
    r"(?<![\w+./:-])(?:"
    r"\+\d{1,3}(?:[ .\-/]?\(?\d{1,5}\)?){2,6}"
    r"|\([2-9]\d\d\)[ .-]?[2-9]\d\d[ .-]\d{4}|[2-9]\d\d[ .-][2-9]\d\d[ .-]\d{4}"
    r"|0\d(?:[ .-]\d\d){4}|0\d{3,4}[ /-]\d{3}[ -]?\d{3,4}|0\d{2,4}[/ ]\d{5,9}|\(0\d{2,4}\) ?\d{3,4}[ -]?\d{3,5}"
    r")(?![\w-]|[.:/]\d)"
)
IDENTITY = re.compile(
    r"(?<![\w.+/-])(?:\d{3}-\d{2}-\d{4}|\d{3}\.\d{3}\.\d{3}-\d{2}|\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01]|[67]\d|8\d|9[01])[-+]\d{4}"
    r"|[A-Z][A-Z] ?\d{2} ?\d{2} ?\d{2} ?[A-D]|\d{8}-?[A-HJ-NP-TV-Z]|[XYZ]-?\d{7,8}-?[A-Z]?"
    r"|(?=(?:[A-Z]*\d){4})[CFGHJK][0-9CFGHJKLMNPRTVWXYZ]{8}|[A-Z]{6}\d{2}[A-EHLMPRST]\d{2}[A-Z]\d{3}[A-Z])(?![\w-]|[.:/]\d)"
)
_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’.-]*"
_STREET = rf"{_CAP}(?:[ ]{_CAP}){{0,3}}"
_TYPES = r"(?:Crescent|Cres|Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Drive|Dr|Court|Ct|Boulevard|Blvd|Way|Place|Pl|Terrace|Close|Square|Sq|Hill|Row|Parkway|Pkwy|Highway|Hwy|Gardens|Grove|Mews|Circle|Trail|Walk|Rise|Quay)"
_SEP = r"(?:,\s?|\s)"
ADDRESS = re.compile(
    rf"(?<![\w/.-])(?:"
    rf"(?:(?:Flat|Apt|Apartment|Unit|Suite|Room)\.? ?\d{{1,4}}[A-Za-z]?{_SEP})?\d{{1,5}}[A-Za-z]?(?:-\d{{1,5}})? (?:{_CAP} ){{1,3}}{_TYPES}(?![\w-])\.?"
    rf"|\d{{1,5}}(?: ?(?:bis|ter|quater))?{_SEP}(?:rue|avenue|boulevard|chemin|allée|allee|impasse|quai|route|cours|ruelle)\s(?:(?:de la|de l'|de|des|du|d'|de l’|d’)\s?)?{_STREET}"
    rf"|(?:ul\.|ulica|al\.|aleja|os\.)\s{_STREET}\s\d{{1,4}}[A-Za-z]?(?:/\d{{1,4}})?"
    rf"|(?:Calle|C/|Cl\.|Avda\.?|Avenida|Paseo|Plaza|Camino|Carrer|Ronda)\s(?:(?:de la|de los|de las|del|de)\s)?{_STREET}{_SEP}(?:n\.?º ?)?\d{{1,4}}"
    rf"|(?:Rua|Avenida|Av\.|Travessa|Praça|Alameda|Estrada)\s(?:(?:da|do|das|dos|de)\s)?{_STREET}{_SEP}(?:nº ?)?\d{{1,5}}"
    rf"|(?:[Vv]ia|[Vv]iale|[Pp]iazza|[Cc]orso)\s{_STREET}{_SEP}\d{{1,4}}"
    rf"|(?:{_CAP}[ -])?[A-ZÀ-ÖØ-Þ][\w'’-]*(?:weg|straße|strasse|str\.|gasse|platz|allee|ufer|damm|ring|gatan|vägen|gränd|straat|laan)\s\d{{1,4}}[a-z]?"
    rf"|{_CAP}[ -](?:Weg|Straße|Strasse|Str\.|Gasse|Platz|Allee|Ufer|Damm)\s\d{{1,4}}[a-z]?"
    rf")(?![\w])"
)
_DIGIT = re.compile(r"\d")
#: What a text must hold to hold a number or an address at all.
_LONG = re.compile(r"\d[\d ().\-/+]{6,}\d|[A-Z][A-Z] ?\d\d ?\d|\d{7}|[A-Z]\d\d[A-Z]|\d{6}[-+]\d|\d{3}-\d\d-\d")
_STREETS = (
    "Cres", "St", " Road", " Rd", " Ave", " Lane", " Ln", " Dr", " Court", " Ct", " Blvd", " Boulevard", " Way", " Pl", " Terrace", " Close", " Sq", " Hill", " Row", " Park", " Pkwy", " High", " Hwy",
    " Garden", " Grove", " Mews", " Circle", " Trail", " Walk", " Rise", " Quay", "rue", "avenue", "boulevard", "chemin", "allée", "allee", "impasse", "quai ", "route ", "cours ", "ul", "al.", "aleja", "os.",
    "Calle", "C/", "Cl.", "Avda", "Avenida", "Av.", "Paseo", "Plaza", "Camino", "Carrer", "Ronda", "Rua", "Travessa", "Pra\u00e7a", "Alameda", "Estrada", "ia ", "iale ", "iazza ", "orso ", "weg ", "stra\u00dfe ",
    "strasse ", "str. ", "gasse ", "platz ", "ufer ", "damm ", "ring ", "gatan ", "v\u00e4gen ", "gr\u00e4nd ", "straat ", "laan ", "Weg ", "Stra\u00dfe ", "Strasse ", "Str. ", "Gasse ", "Platz ", "Allee ", "Ufer ", "Damm ",
)
_URL = re.compile(r"(?:https?|ftp|ssh|git)://\S+|(?<![\w])www\.\S+")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_GAP = re.compile(r"[    ]{1,2}\Z|\r?\n\Z")
_INITIALS = re.compile(r"(?<![\w.@/-])(?:[^\W\d_a-zа-я]\.[  ]?){1,3}\Z|(?<![\w.@/'’-])[^\W\d_a-zа-я][  ]\Z")
_LATIN = re.compile(r"[a-z]")


def _key(word: str) -> str:
    """The term of a word: folded, by its skeleton where it is not in Latin letters."""
    low = fold(word)
    if word.isascii():
        return low
    return skeleton(word) if not _LATIN.search(word.lower()) else low


class Given:
    """A set of given names, also by skeleton for other scripts."""

    def __init__(self, names: list[str]) -> None:
        self.names = frozenset(fold(n) for n in names)
        self.alike = frozenset(skeleton(n) for n in names)

    def __contains__(self, word: str) -> bool:
        first = word.split("-", 1)[0] if "-" in word else word
        if first.isascii():
            return first.lower() in self.names
        return fold(first) in self.names or (not _LATIN.search(first.lower()) and skeleton(first) in self.alike)


def _trimmed(number: str) -> str:
    """A number without signs at its end that belong to the text."""
    number = number.rstrip(" .-/")
    return number[:-1].rstrip() if number.endswith(")") and number.count("(") < number.count(")") else number


def _spans(text: str) -> tuple[list[tuple[str, int, int]], str]:
    """(type, start, end) of everything with a form of its own, and the text with these blanked."""
    found: list[tuple[str, int, int]] = []
    if "://" in text or "www." in text:
        text = _URL.sub(lambda m: "/" * len(m.group()), text)
    low = text.lower()

    def take(kind: str, pattern: re.Pattern[str], ok=None) -> None:
        nonlocal text
        blanks = []
        for m in pattern.finditer(text):
            if ok is None or ok(m):
                end = m.start() + len(_trimmed(m.group())) if kind == "phone" else m.end()
                found.append((kind, m.start(), end))
                blanks.append((m.start(), end))
            elif kind == "email":
                blanks.append(m.span())
        for a, b in blanks:
            text = text[:a] + "/" * (b - a) + text[b:]

    if "@" in text or "＠" in text or "at" in low or "&#64;" in text or "%40" in text:
        if "@" in text or "＠" in text or "(at)" in low or "[at]" in low or "{at}" in low or "<at>" in low or "&#64;" in text or "%40" in text or " AT " in text:
            take("email", EMAIL, lambda m: m.group(1).lower() not in MACHINES)
        if " dot " in low or "dot)" in low or "dot]" in low or "dot}" in low or "dot>" in low:
            take("email", EMAIL_WORDS, lambda m: m.group(1).lower() not in MACHINES)
    if _DIGIT.search(text):
        text = unfold_digits(text)
        if _LONG.search(text):
            take("identity_number", IDENTITY)
            take("phone", PHONE, lambda m: 8 <= sum(c.isdigit() for c in m.group()) <= 15)
        if any(h in text for h in _STREETS):
            take("street_address", ADDRESS)
    return found, text


_WIDE = {ord("０") + i: str(i) for i in range(10)} | {ord("＋"): "+", ord("（"): "(", ord("）"): ")", 0x2010: "-", 0x2011: "-", 0x2013: "-", 0xA0: " ", 0x202F: " ", 0x2009: " "}


_ODD = re.compile(f"[{''.join(map(chr, _WIDE))}]")


def unfold_digits(text: str) -> str:
    """Wide digits and signs, odd hyphens and blanks as plain ones, one for one."""
    return text.translate(_WIDE) if _ODD.search(text) else text


class Scanner:
    """Scans texts one by one and counts their words; what is known of a spelling is kept."""

    def __init__(self, names: list[str]) -> None:
        self.given = Given(names)
        self.seen: Counter[str] = Counter()
        self.slots: Counter[str] = Counter()
        self.given_forms: set[str] = set()
        self.other_forms: set[str] = set()

    def scan(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, str, int]]]:
        """Hits with a form of their own, and possible names (start, end, family term, order)."""
        hits, rest = _spans(text)
        words = _WORD.findall(rest)
        self.seen.update(words)
        for w in set(words).difference(self.given_forms, self.other_forms):
            if len(self.other_forms) > 1_000_000:
                self.other_forms.clear()
            (self.given_forms if len(w) > 1 and (w in self.given or _glued(w, self.given)) else self.other_forms).add(w)
        if self.given_forms.isdisjoint(words) and not _INITIAL.search(rest):
            return hits, []
        names = _names(rest, self.given)
        starts = {a for a, _, _, order in names if order == PLAIN}
        for a, b, term, order in names:  # turned without comma counts only where no plain reading competes
            if order != TURNED or not any(a < x < b for x in starts):
                self.slots[term] += 1
        return hits, names

    def counts(self) -> Counter[str]:
        """Occurrences of each term, all spellings together."""
        out: Counter[str] = Counter()
        for word, n in self.seen.items():
            out[_key(word)] += n
            if glued := _glued(word, self.given):
                out[_key(glued)] += n
        return out


_UPPER = "A-Z\u00c0-\u00d6\u00d8-\u00de\u0410-\u042f"
_INITIAL = re.compile(rf"(?<![^\W_])[{_UPPER}](?:\.[ \u00a0]?|[ \u00a0])(?=[{_UPPER}])|, [{_UPPER}]\.")
_GLUED = re.compile(r"([A-Z\u00c0-\u00de][a-z\u00df-\u00ff]+)([A-Z\u00c0-\u00de][a-z\u00df-\u00ff]+)\Z")


def _glued(word: str, given: Given) -> str | None:
    """The family name of a word like GivenFamily."""
    if len(word) > 4 and not word.isupper() and not word.islower() and (m := _GLUED.match(word)) and m.group(1) in given and m.group(2) not in given:
        return m.group(2)
    return None


def _names(text: str, given: Given) -> list[tuple[int, int, str, int]]:
    """(start, end, term of the family name, order of the parts) of each possible name."""
    words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(text)]
    is_given = [len(w) > 1 and w in given for _, _, w in words]
    out: list[tuple[int, int, str, int]] = []
    size = len(words)

    def free(i: int) -> bool:
        a, b, _ = words[i]
        before, after = text[a - 1 : a], text[b : b + 1]
        return before not in ("_", "/", "@", "#", "\\", "$", "=", "`", "-") and after not in ("_", "/", "@", "\\", "=", "(", "`") and not (after == "." and text[b + 1 : b + 2].isalnum()) and not before.isdigit() and not after.isdigit()

    def family(i: int, beside: str = "a") -> bool:
        """Can word i be a family name? It is not in lower case beside a given name that is not."""
        return i < size and len(words[i][2]) >= LEAST_FAMILY and not is_given[i] and (beside[0].islower() or not words[i][2].islower()) and free(i)

    for i in range(size):
        a, b, w = words[i]
        if is_given[i] and free(i):
            j = i + 1
            if j < size and len(words[j][2]) == 1 and _GAP.match(text[b : words[j][0]]):  # a middle initial
                gap_end = words[j + 1][0] if j + 1 < size else len(text)
                if re.fullmatch(r"\.?[  ]{1,2}", text[words[j][1] : gap_end]):
                    j += 1
                    if family(j, w):
                        out.append((a, words[j][1], _key(words[j][2]), PLAIN))
                        continue
            elif j < size and _GAP.match(text[b : words[j][0]]) and "\n" not in text[b : words[j][0]]:
                if is_given[j] and j + 1 < size and _GAP.match(text[words[j][1] : words[j + 1][0]]) and "\n" not in text[words[j][1] : words[j + 1][0]] and family(j + 1, w):
                    if not (out and out[-1][1] > a):
                        out.append((a, words[j + 1][1], _key(words[j + 1][2]), PLAIN))
                elif family(j, w):
                    if not (out and out[-1][1] == words[j][1] and out[-1][3] == PLAIN):
                        out.append((a, words[j][1], _key(words[j][2]), PLAIN))
            # turned round: Family, Given or Family Given
            if i and family(i - 1, w):
                gap = text[words[i - 1][1] : a]
                if gap in (", ", ","):
                    out.append((words[i - 1][0], b, _key(words[i - 1][2]), COMMA))
                elif gap == " " and words[i - 1][2][0].isupper() and w[0].isupper():
                    out.append((words[i - 1][0], b, _key(words[i - 1][2]), TURNED))
        elif len(w) == 1 and w.isupper() and free_initial(text, a):
            # initials before a family name, or after one and a comma
            j, end = i, b
            while j + 1 < size and len(words[j + 1][2]) == 1 and words[j + 1][2].isupper() and re.fullmatch(r"\.[  ]?", text[end : words[j + 1][0]]):
                j += 1
                end = words[j][1]
            if j + 1 < size and family(j + 1) and words[j + 1][2][0].isupper():
                if re.fullmatch(r"\.[  ]?|[  ]", text[end : words[j + 1][0]]) and not (out and out[-1][1] >= words[j + 1][1]):
                    out.append((a, words[j + 1][1], _key(words[j + 1][2]), PLAIN))
            if i and text[b : b + 1] == "." and text[words[i - 1][1] : a] == ", " and family(i - 1) and words[i - 1][2][0].isupper():
                out.append((words[i - 1][0], b + 1, _key(words[i - 1][2]), COMMA))
        elif free(i) and (glued := _glued(w, given)):
            out.append((a, b, _key(glued), PLAIN))
    return out


def free_initial(text: str, at: int) -> bool:
    """Does a single letter stand by itself?"""
    before = text[at - 1 : at]
    return not before or before.isspace() or before in "(<[{\"'“„«:;,>/*|（：、，。"


def given_names(names: DataFrame, column: str) -> DataFrame:
    """(word): the words of a column of personal names that are given names: they
    have many different partners, and mostly stand first, or first behind a comma."""
    bare = F.regexp_replace(F.col(column), r"\(.*?\)|\[.*?\]|\{.*?\}|\|.*$", " ")
    ordered = F.regexp_replace(bare, r"^([^,]+),([^,]+)$", "$2 $1")
    plain = F.trim(F.regexp_replace(F.lower(ordered), r"[^\p{L}]+", " "))
    full = names.select(F.array_except(F.array_distinct(F.split(plain, " ")), F.array(*[F.lit(t) for t in TITLES])).alias("w")).filter((F.size("w") > 1) & (F.size("w") <= 6)).distinct()
    placed = full.select(F.posexplode("w").alias("pos", "word")).groupBy("word").agg(F.avg((F.col("pos") == 0).cast("double")).alias("leads"))
    pairs = full.select(F.explode("w").alias("word"), "w").select("word", F.explode("w").alias("other")).filter("word <> other and length(word) > 1 and length(other) > 2").distinct()
    partners = pairs.groupBy("word").agg(F.count("*").alias("n"))
    total = partners.agg(F.sum("n").alias("all"))
    many = partners.crossJoin(F.broadcast(total)).filter(F.col("n") >= F.greatest(F.lit(GIVEN_LEAST), F.col("all") * GIVEN_SHARE))
    return many.join(placed, "word").filter(F.col("leads") >= GIVEN_LEADS).select("word")


def find_pii(texts: DataFrame, given: list[str], disclosure: float = DISCLOSURE, smoothing: float = SMOOTHING) -> DataFrame:
    """(source_table, record_id, version, pii_type, start_pos, end_pos) from
    texts(source_table, record_id, version, text).

    Positions count code points from 0. Null and empty texts have no hits.
    Every text is scanned once and whole, where it is read; the counts of the
    terms cover all texts and are combined before they are shuffled.
    """
    known = texts.sparkSession.sparkContext.broadcast(sorted(given))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(known.value)
        columns = ["source_table", "record_id", "version", "pii_type", "start_pos", "end_pos", "term", "n", "s"]
        for pdf in batches:
            rows = []
            for table, record, version, text in zip(pdf["source_table"], pdf["record_id"], pdf["version"], pdf["text"]):
                hits, people = scanner.scan(text)
                for kind, a, b in hits:
                    rows.append((table, record, version, kind, a, b, None, 0, 0))
                for a, b, term, order in people:
                    rows.append((table, record, version, "name" if order == PLAIN else "name2", a, b, term, 0, 0))
            yield pd.DataFrame(rows, columns=columns)
        counts, slots = scanner.counts(), scanner.slots
        stats = [(None, None, None, None, 0, 0, t, n, slots[t]) for t, n in counts.items() if len(t) >= LEAST_FAMILY]
        stats.append((None, None, None, None, 0, 0, "", sum(counts.values()), sum(slots.values())))
        for i in range(0, len(stats), 50_000):
            yield pd.DataFrame(stats[i : i + 50_000], columns=columns)

    version = texts.schema["version"].dataType.simpleString()
    schema = f"source_table string, record_id string, version {version}, pii_type string, start_pos int, end_pos int, term string, n long, s long"
    scanned = cut(spread(texts.select("source_table", "record_id", "version", "text").filter("text is not null and text <> ''")).mapInPandas(scan, schema))
    hits = scanned.filter("pii_type is not null and term is null").select("source_table", "record_id", "version", "pii_type", "start_pos", "end_pos")
    counts = scanned.filter("pii_type is null").groupBy("term").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    revealing = slot_disclosure(counts, smoothing).filter(F.col("disclosure") >= disclosure).select("term")
    people = scanned.filter("pii_type in ('name', 'name2')").join(revealing, "term")
    # where two readings overlap, the plain order of the words holds
    plain = people.filter("pii_type = 'name'")
    turned = people.filter("pii_type = 'name2'").alias("t")
    other = plain.select(*[F.col(c).alias(f"o_{c}") for c in ("source_table", "record_id", "version", "start_pos", "end_pos")])
    apart = turned.join(
        other,
        (F.col("t.source_table") == F.col("o_source_table")) & (F.col("t.record_id") == F.col("o_record_id")) & F.col("t.version").eqNullSafe(F.col("o_version")) & (F.col("t.start_pos") < F.col("o_end_pos")) & (F.col("o_start_pos") < F.col("t.end_pos")),
        "left_anti",
    )
    people = plain.unionByName(apart).select("source_table", "record_id", "version", F.lit("name").alias("pii_type"), "start_pos", "end_pos")
    return hits.unionByName(people)


def slot_disclosure(counts: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """(term, disclosure) from counts(term, n, s): occurrences of each term and those in a slot; the
    row with the empty term holds those of all terms. 1 for a term always in a slot, 0 for one that
    says nothing about it, less for one that speaks against it."""
    base = counts.filter("term = ''").select((F.col("s") / F.col("n")).alias("p"))
    share = (F.col("s") + F.lit(smoothing) * F.col("p")) / (F.col("n") + F.lit(smoothing))
    told = counts.filter("term <> '' and s > 0").crossJoin(F.broadcast(base))  # one row
    return told.select("term", (F.log2(share / F.col("p")) / F.greatest(-F.log2("p"), F.lit(1e-9))).alias("disclosure"))


def disclosing_terms(texts: DataFrame, named: DataFrame, disclosure: float = PERSON_DISCLOSURE, least: int = PERSON_TEXTS) -> DataFrame:
    """(person, term, n_texts, disclosure): terms that give a person away.

    texts has (key, text), one row for each, named (key, person): the persons that
    a text names. A term is a word of three letters or more, once for each text.
    Its disclosure of a person is PMI(term; person) / IC(person), so 1 where every text with the term
    names that person; it needs `least` texts with both. Terms are counted over
    all texts, pairs only in those that name somebody.
    """
    plain = texts.filter("key is not null and text is not null")
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}[\p{L}\p{M}\p{N}_'-]{2,}"), F.lit(0)))
    size = plain.agg(F.count("*").alias("size"))
    people = named.select("key", "person").dropna().distinct()
    each = people.groupBy("person").agg(F.count("*").alias("n_person"))
    both = plain.join(people, "key").select("person", F.explode(words("text")).alias("term")).groupBy("person", "term").agg(F.count("*").alias("n_texts")).filter(F.col("n_texts") >= least)
    asked = both.select("term").distinct()
    often = plain.select(F.explode(words("text")).alias("term")).groupBy("term").agg(F.count("*").alias("n_term")).join(asked, "term", "left_semi")
    told = both.join(often, "term").join(each, "person").crossJoin(F.broadcast(size))  # one row
    content = F.greatest(F.log2(F.col("size") / F.col("n_person")), F.lit(1e-9))
    pmi = F.log2(F.col("n_texts") * F.col("size") / (F.col("n_term") * F.col("n_person")))
    return told.select("person", "term", "n_texts", (pmi / content).alias("disclosure")).filter(F.col("disclosure") >= disclosure)


def replace_spans(text: str, spans: list[tuple[int, int, str]]) -> str:
    """text with each (start, end, type) replaced by [TYPE]; of overlapping spans the first holds."""
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
    return "".join([*out, text[at:]])
