"""Template residue, filler, error pages and scripts-required notices (problem 9).

Phrases of many languages stand in one automaton, each of a class: what an
error page, a filler or a scripts-required notice says, and the frame of such
pages (navigation, apologies, references), which adds to the coverage but is
no evidence. A text is freed of code and quotations and cut into sentences; a
sentence is residue where it holds evidence and its matched coverage is high
relative to its length, so that a sentence that only speaks of an error page
does not count. Unfilled placeholders count outside code where the sentence
does not speak of templates. A document is excluded where the residue covers
enough of it: any unfilled placeholder, or residue beyond a share of the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: Matched share of a sentence from which it is residue, and of a document from which it is excluded.
SENTENCE_COVERAGE, DOCUMENT_COVERAGE = 0.72, 0.03

# Phrases in lower case; fixed values. A '#' stands for any run of digits, '@' for any hex reference.
ERRORS = """
page not found|not found|this page does not exist any more|this page does not exist|the page does not exist|page does not exist|page you requested could not be found|you asked for could not be found|you are looking for does not exist|could not be found
was moved or removed|has been moved or removed|has been removed|was deleted|could not be loaded|cannot be loaded|is gone|timed out|has timed out|does not respond|is not responding|is not reachable right now|is not reachable|failed unexpectedly|is not available in your region|is currently unavailable|is temporarily unavailable|is unavailable|was loaded incorrectly
something went wrong|something broke on our side|an unexpected error occurred|an error has occurred|an error occurred|the server could not finish the request|we lost that page|we can't find that page|we couldn't find that page|we could not find that page
internal server error|bad gateway|gateway trouble|gateway timeout|gateway time-out|service unavailable|service temporarily unavailable|temporarily unavailable|maintenance window until # utc|down for maintenance|under maintenance|forbidden|access denied|access to this resource is denied for your account|access to this resource is denied|access to this page has been denied|is denied for your account|you do not have permission to view this page|permission denied
too many requests|slow down and retry after # seconds|rate limit exceeded|connection refused|connection reset|connection timed out|database connection failed|too many clients|too many connections|error establishing a database connection|warning in index line #|uncaught exception in handler|unhandled exception|upstream returned #|fatal error|stack trace
your session has expired|session expired|log in again to see this page|please log in to see this page|please sign in to continue|<center><h#>#</h#></center>|<hr><center>proxy/#</center>|<hr><center>nginx|<h#>#</h#>
seite nicht gefunden|diese seite existiert nicht mehr|diese seite existiert nicht|diese seite ist nicht verfügbar|ein fehler ist aufgetreten|zugriff verweigert|interner serverfehler|dienst nicht verfügbar|die seite konnte nicht geladen werden
cette page est introuvable|page introuvable|page non trouvée|cette page n'existe pas|cette page n'existe plus|une erreur est survenue|une erreur s'est produite|accès refusé|accès interdit|service indisponible
página no encontrada|la página no existe|esta página no existe|esta página ya no existe|no se encontró la página|ha ocurrido un error|se ha producido un error|acceso denegado|servicio no disponible
página não encontrada|a página não existe|esta página não existe|ocorreu um erro|acesso negado|serviço indisponível|pagina non trovata|pagina niet gevonden|sidan hittades inte|nie znaleziono strony|strona nie istnieje
страница не найдена|страница не существует|такой страницы нет|произошла ошибка|доступ запрещён|доступ запрещен|сервис временно недоступен|внутренняя ошибка сервера
ページが見つかりません|ページは見つかりませんでした|お探しのページは見つかりません|エラーが発生しました|アクセスが拒否されました|サービスは一時的に利用できません|页面不存在|页面未找到|找不到页面|找不到该页面|发生错误|访问被拒绝|服务暂时不可用|服务器错误
"""
SCRIPTS = """
you need to turn on javascript to run this site|you need to enable javascript to run this app|you need to turn on javascript|you need to enable javascript|please enable javascript to continue|please enable javascript|please activate javascript and cookies to continue|please activate javascript|please turn on javascript|enable javascript and cookies to continue|enable javascript to continue|enable javascript|turn on javascript
javascript is required|javascript seems to be off|javascript is disabled|javascript is turned off|javascript must be enabled|javascript is not enabled|requires javascript|this site requires javascript|this page requires javascript|this app works best with javascript enabled|a browser with js support is needed|your browser does not support javascript
scripts have to be allowed|scripts must be allowed|scripts appear to be blocked|scripts are blocked|client-side scripting must be switched on|client-side scripting must be enabled|your browser must run our code|does not work without scripts|does not work without javascript|enable them in your browser settings and reload|allow scripts from this site|then press continue|your script blocker is probably on|if nothing happens
your browser is blocking a feature this page requires|client-side code|switch it on or use the app|the feed is rendered in the browser|is rendered in the browser|we could not verify your browser|checking that you are a human|checking your browser before accessing|verify you are human|verifying you are human|this takes a few seconds|this may take a few seconds
bitte aktiviere javascript, um diese seite zu sehen|bitte aktivieren sie javascript|bitte aktiviere javascript|javascript ist deaktiviert|javascript aktivieren|um diese seite zu sehen|um fortzufahren
veuillez activer javascript pour afficher la discussion|veuillez activer javascript|activez javascript|javascript est désactivé|pour afficher la discussion|pour afficher cette page|pour continuer
activa javascript para ver el contenido|activa javascript|active javascript|habilita javascript|habilite javascript|javascript está desactivado|para ver el contenido|para ver esta página|para continuar
ative o javascript para ver o conteúdo|ative o javascript|habilite o javascript|para ver o conteúdo|abilita javascript|schakel javascript in|aktivera javascript|włącz javascript
для просмотра страницы включите javascript|включите javascript|javascript отключен|для просмотра страницы
このページを表示するにはjavascriptを有効にしてください|javascriptを有効にしてください|このページを表示するには|请启用javascript以查看内容|请启用 javascript|请启用javascript|请开启javascript|需要启用javascript
"""
FILLERS = """
lorem ipsum dolor sit amet|lorem ipsum|dolor sit amet|consectetur adipiscing elit|description coming soon|content coming soon|more info coming soon|more details coming soon|text coming soon|coming soon|this is a placeholder paragraph|this is placeholder text|this is a placeholder|placeholder text|placeholder paragraph
sample text goes here|your text goes here|text goes here|content goes here|body copy to be written|copy to be written|to be written|put your intro here|put your text here|put your content here|insert text here|insert content here|add your text here|write your text here|todo write something nice about the event|todo write something|todo: write|todo add content|something nice about the event
test test test|asdf asdf|foo bar baz|heading heading subheading|heading subheading|click here to edit|double click to edit|edit this text|this is a sample page|hello world! this is your first post|welcome to your new site
texte à venir|contenu à venir|description à venir|texte de remplissage|texte d'exemple|hier steht bald ein text|hier entsteht|text folgt|inhalt folgt|beschreibung folgt|platzhaltertext|beispieltext|blindtext
próximamente|texto de ejemplo|texto de relleno|texto aquí|contenido próximamente|descripción próximamente|em breve|texto de exemplo|testo segnaposto|testo in arrivo|tekst wkrótce
текст скоро появится|описание скоро появится|здесь будет текст|здесь будет описание|текст-заполнитель|サンプルテキスト|ダミーテキスト|ここに本文が入ります|ここにテキストを入力|準備中|示例文本|占位文本|内容待补充|敬请期待
"""
FRAMES = """
menu search sign up|menu|search|sign up|home | threads | log in|home|threads|log in|© community hub|community hub|back to start|help · status · terms|help|status|terms|privacy|cookies|copyright|all rights reserved
community thread|event page|profile|readme|this thread|this link|this page|this post|this forum|this view|this site|the page|the profile|the readme|the thread|the event page|the event|that event|that page|the upstream service|your request|the link|the post|your account|sign-up|before we continue|to read this thread|for the full page|to see this page|to view this page|noscript
error #|http #|status #|fehler #|erreur #|código #|código de error #|codice #|ошибка #|code #|[#]|(code #)|(fehler #)|（#）|(#)|(noscript)|(ref @)|ref @|incident @|request id @|reference @|reference|ref
oops|whoops|sorry|uh oh|hoppla|try later|try again|please try again|please try again later|try again later|in a few minutes|reload the page to try again|reload the page|reload afterwards|check the address and reload|go back to the start page|return to the overview|return to the home page|return home|use the search box|or return home|our team has been informed|zurück zur übersicht|zurück zur startseite|retour à l'accueil|volver al inicio|see your settings|and cookies too|and cookies|content is loading|loading|please wait|right now
"""
#: Words by which a sentence speaks of templates instead of being one; fixed values.
ABOUT = re.compile(
    r"templat|plantilla|vorlage|gabarit|шаблон|テンプレート|模板|\bscripts?\b|replac|environment|\benv\b|marker|f-string|print\(|\berb\b|handlebars|jinja|mustache|liquid|syntax|variable|escap|render|\bengine\b|keeps? (?:writing|printing|inserting)|linter|\blint\b|regex|prompt library|interpolat|brace|bracket|parser|shell|bash|config|substitut|placeholder|snippet|literal|tokens? like|string"
)
_NAME = r"[A-Za-z][A-Za-z0-9_.-]*(?: [A-Za-z0-9_]+){0,4}"
_HTML = "a|abbr|address|article|aside|audio|b|base|blockquote|body|br|button|canvas|caption|center|cite|code|col|dd|del|details|div|dl|dt|em|embed|fieldset|figure|font|footer|form|h[1-6]|head|header|hr|html|i|iframe|img|input|ins|kbd|label|legend|li|link|main|map|mark|meta|nav|object|ol|option|p|param|pre|script|section|select|small|source|span|strong|style|sub|summary|sup|svg|table|tbody|td|template|textarea|tfoot|th|thead|time|title|tr|tt|u|ul|var|video"
#: The shapes of unfilled placeholders.
PLACEHOLDER = re.compile(
    rf"\{{\{{\{{? ?[#/^>&]?{_NAME} ?\}}?\}}\}}|[$#]\{{ ?{_NAME} ?\}}|\[\[ ?{_NAME} ?\]\]|<%[=-]? ?{_NAME} ?-?%>|\*\|{_NAME}\|\*|@@{_NAME}@@|«[A-Za-z][A-Za-z0-9_]*»|"
    rf"(?<![A-Za-z0-9_])(?:__[A-Z][A-Z0-9_]*__|XX_[A-Za-z0-9_]+_XX)(?![A-Za-z0-9_])|%[A-Z][A-Z0-9_]+%|(?<![\w$])\$[A-Za-z][A-Za-z_]+\$(?![\w$])|"
    rf"(?<![\w${{#\"'(])\{{[a-z][a-z_]+\}}(?![}}\"'])|(?<![\w<])<(?!/?(?:{_HTML})\b)[a-z]+(?:[ _][a-z]+){{0,3}}>|"
    r"\[(?:[Yy]our|YOUR|[Ii]nsert|INSERT|[Ee]nter|ENTER|[Aa]dd|ADD|[Pp]ut|PUT)(?: [A-Za-z_]+){1,5}\]|\((?:[A-Za-z_]+ ){1,4}(?:goes|GOES|go|GO) (?:here|HERE)\)"
)
_CODE = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)|<(pre|code)>.*?</\1>|`[^`\n]*`|^(?: {4}|\t).*$", re.S | re.M)
_QUOTE = re.compile(r"\"[^\"\n]{1,200}\"|“[^”\n]{1,200}”|„[^“”\n]{1,200}[“”]|«\s?[^»\n]*\s[^»\n]*»|「[^」\n]{1,200}」|『[^』\n]{1,200}』")
_QUOTED = re.compile("[\"“„«「『]")
_SENTENCE = re.compile(r"\n+|(?<=[.!?…])\s+(?=\S)|(?<=[。！？])|\s{2,}(?=[A-ZÀ-Þ])|(?<=\S)\s+(?=(?:menu  ?search|home \| threads|help · status|back to start|© community))", re.I)
_HEADED = re.compile(r"\s*#+\s*\Z")
_WORD = re.compile(r"[^\W\d_]+")
_SIGNIFICANT = re.compile(r"[^\W_]")
#: Short words that running text in one of these languages cannot do without; fixed values.
COMMON = frozenset(
    "the a an and or to of in is it on for with that this was are be as at by from not but i you we they my our your its have has had can will no if so do does who what why how when there he she s t "
    "de la el los las un una y que en es se por con para su al del le les des du et est une dans pour sur pas qui ne au je il nous vous ce der die das und ist ein eine zu den von mit auf für nicht im dem sich auch wir ich es wie noch bei "
    "o os as e um uma do da dos das em no na com não por mais i w z na nie się jest do och att det som en på är av till inte "
    "и в не на я что с по это как мы для из у за от он но все".split()
)


class Phrases:
    """The automaton over all phrases, by class."""

    def __init__(self, left_out: frozenset[str] = frozenset()) -> None:
        """left_out: phrases not to be used, for measuring how much depends on single ones."""
        self.automaton = ahocorasick.Automaton()
        for kind, block in (("frame", FRAMES), ("filler", FILLERS), ("script", SCRIPTS), ("error", ERRORS)):
            for phrase in block.replace("\n", "|").split("|"):
                if (p := _mask(phrase.strip())) and len(p) > 1 and phrase.strip() not in left_out:
                    self.automaton.add_word(p, (len(p), kind))
        for phrase in ("home | threads | log in", "*|"):
            self.automaton.add_word(phrase, (len(phrase), "frame"))
        # a second automaton without the frames, with what opens a placeholder, tells what a text can hold at all
        self.first = ahocorasick.Automaton()
        for phrase in self.automaton:
            kind = self.automaton.get(phrase)[1]
            if kind != "frame":
                self.first.add_word(phrase, kind)
        for opener in OPENERS:
            self.first.add_word(opener, "placeholder")
        self.automaton.make_automaton()
        self.first.make_automaton()

    def signs(self, text: str) -> set[str]:
        """Which classes the text may hold: one pass over the whole of it."""
        return {kind for _, kind in self.first.iter(_mask(text))}

    def cover(self, sentence: str) -> tuple[float, set[str]]:
        """The matched share of the letters and digits, and the classes of evidence."""
        text = _mask(sentence)
        spans, kinds = [], set()
        for end, (n, kind) in self.automaton.iter(text):
            start = end - n + 1
            if text[start].isalnum() and start and text[start - 1].isalnum() and text[start].isascii() or text[end].isalnum() and text[end].isascii() and end + 1 < len(text) and text[end + 1].isalnum() and text[end + 1].isascii():
                continue
            spans.append((start, end + 1))
            if kind != "frame":
                kinds.add(kind)
        if not kinds:
            return 0.0, kinds
        covered = bytearray(len(text))
        for start, end in spans:
            covered[start:end] = b"\x01" * (end - start)
        total = matched = 0
        for c, m in zip(text, covered):
            if c.isalnum() or c == "#" or c == "@":
                total += 1
                matched += m
        return (matched / total if total else 0.0), kinds


#: How the shapes of PLACEHOLDER begin or, those in brackets of words, end, in lower case.
OPENERS = ("{", "[[", "<", "*|", "@@", "«", "__", "xx_", "%", "$", "[your", "[insert", "[enter", "[add", "[put", " here)")
_HEX = re.compile(r"(?<![\w])(?=[a-f]*\d)[0-9a-f]{6,}(?![\w])")
_DIGITS = re.compile(r"\d+(?:[.:,]\d+)*")
_DIGIT = re.compile(r"\d")
_BLANKS = re.compile(r"\s+")


def _mask(text: str) -> str:
    text = _BLANKS.sub(" ", unicodedata.normalize("NFC", text.lower()).replace("’", "'"))
    text = text if not _DIGIT.search(text) else _DIGITS.sub("#", _HEX.sub("@", text))
    return text.strip(" ")


def babble(words: list[str]) -> bool:
    """Pseudo-text: few different words in ever new order, hardly any that
    running text needs. Repeated sentences repeat their pairs of words too."""
    if len(words) < 12:
        return False
    different = len(set(words))
    if different > 0.75 * len(words) or sum(w in COMMON for w in words) > 0.15 * len(words):
        return False
    return len(set(zip(words, words[1:]))) >= 1.3 * different


def _strange_runs(block: str) -> Iterator[tuple[bool, list[str]]]:
    """(is it pseudo-text by its form alone, words) of each run of sentences that
    hardly use words of running text: it opens as lorem ipsum, or holds nothing but
    words, some of them again, in an order that does not come again."""
    if not block.isascii():
        return
    led, run, plain = False, [], True
    opens = block.lstrip().lower().startswith("lorem ipsum")
    if not opens and block.count(" ") < 7 and len(_WORD.findall(block)) < 8:
        return  # too short for a run
    for sentence in [*re.split(r"(?<=[.!?])\s+", block), "the of and to"]:
        words = _WORD.findall(sentence.lower())
        common = sum(w in COMMON for w in words)
        if opens and len(words) > 3 and common <= 0.4 * len(words):
            led, run = True, words
        elif common <= (0.4 if led else 0.2) * len(words):
            run += words
            plain = plain and bool(_PLAIN.match(sentence))
        elif run:
            different = len(set(run))
            again = plain and len(run) >= 8 and different <= 0.93 * len(run) and sum(w in COMMON for w in run) <= 0.12 * len(run) and len(set(zip(run, run[1:]))) > different
            yield led or again, run
            led, run, plain = False, [], True
        opens = False


_PLAIN = re.compile(r"[A-Za-z ,.!?]*\Z")


def judge(text: str | None, phrases: Phrases) -> tuple[float, str]:
    """(covered share, classes found) of a text; (0, '') for one without residue."""
    if not text or not text.strip():
        return 0.0, ""
    coded = "`" in text or "<" in text or "    " in text or "\t" in text or "~~~" in text
    bare = _CODE.sub(lambda m: "\n" if "\n" in m.group() else " ` ", text) if coded else text
    kinds: set[str] = set()
    residue = 0
    unquoted = _QUOTE.sub(' " ', bare) if _QUOTED.search(bare) else bare
    signs = phrases.signs(unquoted)
    if "placeholder" in signs and not PLACEHOLDER.search(unquoted):
        signs.remove("placeholder")
    for sentence in _SENTENCE.split(unquoted) if signs else ():
        if not sentence or not sentence.strip():
            continue
        found = PLACEHOLDER.search(sentence) if "placeholder" in signs else None
        if found and (_HEADED.match(sentence, 0, found.start()) or ("`" not in sentence and not ABOUT.search(PLACEHOLDER.sub(" ", sentence).lower()))):
            kinds.add("placeholder")
            residue += len(_SIGNIFICANT.findall(sentence))
            continue
        if '"' in sentence or "`" in sentence:
            continue
        share, evidence = phrases.cover(sentence)
        if evidence and share >= SENTENCE_COVERAGE:
            kinds |= evidence
            residue += len(_SIGNIFICANT.findall(sentence))
    for block in re.split(r"\n+", unquoted):
        for led, words in _strange_runs(block):
            if led or babble(words):
                kinds.add("filler")
                residue += sum(map(len, words))
    if not kinds:
        return 0.0, ""
    return min(1.0, residue / (len(_SIGNIFICANT.findall(text)) or 1)), "+".join(sorted(kinds))


def find_residue(df: DataFrame, id_col: str, text_col: str, coverage: float = DOCUMENT_COVERAGE) -> DataFrame:
    """(id_col, residue_kinds, residue_share, excluded) for each row.

    Null, empty and blank texts have no residue. A row is excluded where its
    text holds an unfilled placeholder or more than `coverage` of it is
    residue. Repeated rows are kept. There is no shuffle, texts are judged
    where they are read, whole.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        phrases = Phrases()
        for pdf in batches:
            out = [judge(t, phrases) for t in pdf["text"]]
            pdf["residue_share"], pdf["residue_kinds"] = [o[0] for o in out], [o[1] for o in out]
            yield pdf[["key", "residue_kinds", "residue_share"]]

    two = spread(df.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")))
    judged = two.mapInPandas(run, f"key {id_type}, residue_kinds string, residue_share double")
    excluded = F.col("residue_kinds").contains("placeholder") | ((F.col("residue_kinds") != "") & (F.col("residue_share") > coverage))
    return judged.withColumn("excluded", excluded).withColumnRenamed("key", id_col)
