"""Template residue, filler, error pages, scripts-required notices."""

from __future__ import annotations

import pytest

from commonweave.llm.residue import Phrases, find_residue, judge

BAD = {
    "placeholder": ["Dear {{first_name}}, your seat is confirmed.", "Hi %NAME%, see you.", "# ${venue}", "Join us at [your city here] on [INSERT DATE].", "Bonjour <%= name %>, à bientôt.", "About the host: *|HOST|* is here.", "Starts at (start time goes here). Bring snacks."],
    "filler": ["Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Description coming soon. Description coming soon.", "Test test test.", "asdf foo jkl bar asdf qwer foo bar jkl asdf bar qwer foo asdf", "Texte à venir."],
    "error": ["404 - this page does not exist any more", "Whoops. The profile timed out. Incident 4befdbe1", "Seite nicht gefunden (Fehler 404). Zurück zur Übersicht.", "ページが見つかりません（404）", "The page could not be loaded. Our parser is fine, though, and the rest of this text goes on about it."],
    "script": ["You need to turn on JavaScript to run this site.", "Please enable JavaScript to continue.", "Bitte aktiviere JavaScript, um diese Seite zu sehen.", "To read this thread: scripts have to be allowed, sorry!"],
}
GOOD = [
    "In the template we write `{{ user.handle }}` and the engine fills it in.", "The mail script replaces ${NAME} from the environment, here is how I test it.", "```html\n<h1>{{title}}</h1>\n```\nWhy does the linter drop the braces?",
    'How do you handle "503 Service unavailable" in the client? We retry.', "Changed the page not found copy in 6 languages.", "Someone posted lorem ipsum as a bug report.", "Users with JavaScript disabled see an empty shell, so we render on the server.",
    'f-strings: print(f"{count} rows") is fine.', "<p>Hello</p> we use <b>bold</b> text.", "", "  \n", "Weiß jemand, warum der Index neu aufgebaut wird? Weiß jemand, warum der Index neu aufgebaut wird?",
]


@pytest.fixture(scope="module")
def phrases():
    return Phrases()


@pytest.mark.parametrize("kind", sorted(BAD))
def test_found(phrases, kind):
    for text in BAD[kind]:
        assert kind in judge(text, phrases)[1].split("+"), text


def test_not_found(phrases):
    for text in [*GOOD, None]:
        assert judge(text, phrases) == (0.0, ""), text


def test_rows(spark):
    rows = [(1, BAD["script"][0], "x"), (1, BAD["script"][0], "x"), (2, GOOD[0], None), (3, None, ""), (4, "word and the " * 20_000, ""), (None, BAD["error"][0], "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, excluded string")
    got = find_residue(df, "doc_id", "text").collect()
    assert len(got) == 6 and sorted((str(r["doc_id"]), r["excluded"]) for r in got) == sorted([("1", True), ("1", True), ("2", False), ("3", False), ("4", False), ("None", True)])
    assert find_residue(df.limit(0), "doc_id", "text").count() == 0


def test_first_pass_loses_nothing():
    """The pass over the whole text names every class that a sentence of it may hold."""
    phrases = Phrases()
    for text in ("Intro.\n\nHello {{ user_name }}, welcome!", "It works.\n\n404 Page not found", "Read on.\n(more text goes HERE)", "Dear [Your Name],", "Please enable JavaScript to continue."):
        assert phrases.signs(text), text
        assert judge(text, phrases)[1]
    assert not phrases.signs("We met in the hall and talked about the plan for 2024.")


def test_phrases_left_out():
    """A page is still known by its other phrases."""
    page = "Page not found. This page does not exist any more. Return to the home page."
    assert judge(page, Phrases(frozenset({"page not found"})))[1] == "error"
