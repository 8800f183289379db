"""Names, handles, e-mails and employers of persons and organisations in the
comparable form that matching needs (problems 1 and 5)."""

from __future__ import annotations

import re
from functools import lru_cache

from .editmetric import damerau, fold, skeleton
from .pii import TITLES

#: Words of organisations and their short forms, fixed values.
ORG_WORDS = {
    "foundation": "foundation", "fdn": "foundation", "brothers": "brothers", "bros": "brothers", "laboratories": "labs", "laboratory": "labs", "labs": "labs", "lab": "labs",
    "technologies": "tech", "technology": "tech", "tech": "tech", "international": "intl", "intl": "intl", "manufacturing": "mfg", "mfg": "mfg", "rg": "research group",
    "group": "group", "research": "research", "systems": "systems", "sys": "systems", "software": "software", "studios": "studios", "studio": "studios", "networks": "networks",
    "associates": "associates", "assoc": "associates", "university": "university", "univ": "university", "institute": "institute", "inst": "institute", "department": "department",
    "dept": "department", "corporation": "corporation", "company": "company", "partners": "partners", "holdings": "holdings", "industries": "industries", "ind": "industries",
    "services": "services", "svcs": "services", "solutions": "solutions", "consulting": "consulting", "collective": "collective", "cooperative": "coop", "coop": "coop",
    "society": "society", "association": "association", "community": "community", "project": "project", "enterprises": "enterprises", "works": "works", "engineering": "engineering", "eng": "engineering",
}
#: Legal forms, fixed values.
LEGAL = frozenset("inc ltd llc llp plc gmbh ag ab as oy bv nv sa srl sarl spa kk kg ug co corp limited incorporated pty lda sl se".split())
#: Local parts that belong to a role and not to a person, fixed values.
ROLES = frozenset("team info hello contact office admin support mail sales press hr jobs events community help billing hi all staff".split())
#: What is put before or behind a handle without meaning, fixed values.
_AFFIX = re.compile(r"^(?:the|its|iam|real|hey)(?=[a-z]{5})|(?:dev|codes|hq|io|oss|labs|archive|tv|x)$")
_NOISE = re.compile(r"\s[-–—]\s.*$|\(.*?\)|\[.*?\]|\{.*?\}|\|.*$|,?\s+(?:ph\.?d|m\.?d|msc|bsc|mba)\b\.?.*$", re.I)
_TOKEN = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-zß-ÿ])(?=[A-ZÀ-Þ])")
_HANDLE = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9_.-]{2,}[A-Za-z0-9])?")
_BIO = re.compile(r"@([A-Za-z0-9_.-]{4,}[A-Za-z0-9])|\b([A-Za-z0-9_.-]{4,}[A-Za-z0-9])\s*(?:/|\()\s*(?:on )?(?:twitter|discord|reddit|linkedin|luma|hackernews|forum)\b", re.I)


@lru_cache(maxsize=200_000)
def squash(text: str) -> str:
    """Letters and digits of a folded text."""
    return re.sub(r"[^a-z0-9]+", "", fold(text))


def handle_of(text: str | None) -> str | None:
    """The handle in what was typed: an @, an address or signs around it are dropped."""
    if not text or not text.strip():
        return None
    last = re.sub(r"[/?#]+$", "", text.strip()).rsplit("/", 1)[-1].lstrip("@").strip()
    out = squash(last)
    return out if len(out) >= 3 else None


@lru_cache(maxsize=200_000)
def handle_base(handle: str) -> str:
    """A handle without final digits and meaningless affixes."""
    base = re.sub(r"\d+$", "", handle)
    for _ in range(2):
        shorter = _AFFIX.sub("", base)
        if len(shorter) >= 5:
            base = shorter
    return base if len(base) >= 4 else handle


class Lexicon:
    """Given names, their one-letter-off spellings and aliases."""

    def __init__(self, given: list[str], alias: list[tuple[str, str]]) -> None:
        self.given = frozenset(fold(g) for g in given)
        self.alike = {skeleton(g): g for g in sorted(self.given)}
        self.near: dict[str, list[str]] = {}
        for g in sorted(self.given):
            if len(g) >= 4:
                for v in {g, *(g[:i] + g[i + 1 :] for i in range(len(g)))}:
                    self.near.setdefault(v, []).append(g)
        self.alias: dict[str, set[str]] = {}
        for a, b in alias:
            self.alias.setdefault(a, set()).add(b)
            self.alias.setdefault(b, set()).add(a)

    def lookup(self, token: str, latin: bool, fuzzy: bool) -> str | None:
        """The given name that a token is, or is one letter off."""
        if token in self.given:
            return token
        if not latin:
            return self.alike.get(skeleton(token))
        if fuzzy and len(token) >= 4:
            for v in (token, *(token[:i] + token[i + 1 :] for i in range(len(token)))):
                for g in self.near.get(v, ()):
                    if damerau(token, g) <= 1:
                        return g
        return None


@lru_cache(maxsize=200_000)
def _org_slip(word: str) -> str | None:
    """The kind of organisation that a word names with a typing slip."""
    return next((ORG_WORDS[k] for k in _LONG_KINDS if k[0] == word[0] and abs(len(k) - len(word)) <= 1 and damerau(k, word) <= 1), None)


_LONG_KINDS = sorted(k for k in ORG_WORDS if len(k) >= 7)


def parse_name(name: str | None, lexicon: Lexicon) -> tuple[bool, list[str], list[str], str]:
    """(is it an organisation, given names and initials, family names, kind of organisation).

    Titles, brackets and decorations are dropped, Family-comma-Given is turned
    round, GivenFamily is split; an organisation has its words pressed together
    as its family name and its kind aside.
    """
    if not name or not name.strip():
        return False, [], [], ""
    bare = _NOISE.sub(" ", name).strip()
    raw = [t for t in _TOKEN.findall(bare)]
    low = [fold(t) for t in raw]
    kinds = [ORG_WORDS[w] for w in low if w in ORG_WORDS]
    legal = [w for w in low if w in LEGAL]
    if not kinds and len(raw) > 1:
        for w in low[1:]:  # a kind with a typing slip
            if len(w) >= 6 and (hit := _org_slip(w)):
                kinds, low = [hit], [x for x in low if x != w]
                break
    if kinds or (legal and len(raw) > 1 and not any(lexicon.lookup(w, True, False) for w in low)) or " & " in bare:
        slips = {w: hit for w in low[1:] if w not in ORG_WORDS and len(w) >= 6 and (hit := _org_slip(w))}
        kinds += slips.values()
        core = "".join(w for w in low if w not in ORG_WORDS and w not in slips and w not in LEGAL and w not in ("the", "and") and len(w) > 1)
        return True, [], [core] if core else [], " ".join(sorted(set(" ".join(kinds).split())))
    pairs = [(t, f) for t, f in zip(raw, low) if f.strip(".") not in TITLES or len(f) == 1]
    if len(pairs) == 1 and (m := _CAMEL.search(pairs[0][0])) and not pairs[0][0].isupper():
        a = pairs[0][0]
        pairs = [(a[: m.start()], fold(a[: m.start()])), (a[m.start() :], fold(a[m.start() :]))]
    turned = "," in bare and len(pairs) > 1
    given: list[str] = []
    family: list[str] = []
    for i, (t, f) in enumerate(pairs):
        if len(f) == 1:
            given.append(f)
            continue
        latin = bool(re.search(r"[a-z]", t.lower()))
        hit = lexicon.lookup(f, latin, False)
        if hit:
            given.append(hit)
        else:
            family.append(f if latin else f)
    if len(family) > 1 and not given:  # a given name with a typing slip, at the end it is likely to stand at
        order = [len(family) - 1, 0] if turned else [0, len(family) - 1]
        for i in dict.fromkeys([*order, *range(len(family))]):
            if hit := lexicon.lookup(family[i], True, True):
                given.append(hit)
                family.pop(i)
                break
        else:
            given.append(family.pop(order[0]))
    if not family and len(given) > 1 and len(given[-1]) > 1:
        family.append(given.pop(0 if turned else -1))
    family = [f for f in family if len(f) >= 3] or family
    return False, given, family, ""


def core_key(family: str) -> str:
    """A family name as it is compared: by skeleton, so that scripts and marks fall together."""
    return skeleton(family)


def given_fit(a: list[str], b: list[str], lexicon: Lexicon) -> int:
    """How two lists of given names fit: 3 equal, 2 alias or slip, 1 initial only, 0 unknown on a side, -1 not at all."""
    if not a or not b:
        return 0
    best = -1
    for x in a:
        for y in b:
            if x == y and len(x) > 1:
                return 3
            if len(x) == 1 or len(y) == 1:
                if x[0] == y[0] or any(z[0] == (x if len(x) == 1 else y)[0] for z in lexicon.alias.get(y if len(x) == 1 else x, ())):
                    best = max(best, 1)
            elif y in lexicon.alias.get(x, ()) or (min(len(x), len(y)) >= 3 and (x.startswith(y) or y.startswith(x))) or (min(len(x), len(y)) >= 4 and damerau(x, y) <= 1) or skeleton(x) == skeleton(y):
                best = max(best, 2)
    return best
