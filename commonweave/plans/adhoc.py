"""Guarded ad-hoc SQL: one read-only statement, a row cap, a time limit, a cache and a log."""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, Row, SparkSession


class QueryRefused(ValueError):
    """A statement that is not run, with a code."""

    def __init__(self, code: str, message: str) -> None:
        super().__init__(message)
        self.code = code


@dataclass
class Result:
    """Rows of a query, its columns with types, and how long it took."""

    columns: list[tuple[str, str]]
    rows: list[Row]
    seconds: float
    from_cache: bool = False


def validate(sql: str) -> str:
    """The statement without one closing semicolon; refused unless it is a single SELECT or WITH.
    Semicolons within quotes are part of the text."""
    text = (sql or "").strip()
    text = re.sub(r"^```(?:sql)?\s*|\s*```$", "", text).strip()
    text = re.sub(r"^SQL:\s*", "", text, flags=re.I)
    text = text[:-1].rstrip() if text.endswith(";") else text
    if not text:
        raise QueryRefused("empty", "there is no statement")
    bare = re.sub(r"'(?:[^'\\]|\\.|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", " ", text, flags=re.S)
    if ";" in bare:
        raise QueryRefused("multiple", "only one statement is run")
    if not re.match(r"\s*(select|with)\b", bare, re.I):
        raise QueryRefused("not_select", "only SELECT and WITH are run")
    return text


#: Functions that reach beyond the tables, and those that may stand in place of a table; fixed values.
REFUSED_FUNCTIONS = frozenset({"reflect", "java_method", "try_reflect"})
TABLE_FUNCTIONS = frozenset({"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack", "json_tuple", "variant_explode", "variant_explode_outer"})


def _parts(seq) -> list[str]:
    return [str(seq.apply(i)) for i in range(seq.size())]


def _nodes(node) -> Iterator:
    """Every node of a parsed plan: operators, their expressions, subqueries and named queries."""
    stack = [node]
    while stack:
        at = stack.pop()
        yield at
        for member in ("children", "expressions", "innerChildren"):
            try:
                seq = getattr(at, member)()
            except Exception:  # noqa: BLE001 - not every node has each of them
                continue
            stack += [seq.apply(i) for i in range(seq.size())]
        if "Subquery" in at.getClass().getSimpleName() and hasattr(at, "plan"):
            try:
                stack.append(at.plan())
            except Exception:  # noqa: BLE001 - an alias of a subquery has it as its child
                continue


def check_reach(spark: SparkSession, text: str) -> None:
    """Refuses a statement that reads anything but tables and views of the catalog, or calls methods of the JVM."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)  # noqa: SLF001
    for node in _nodes(plan):
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedRelation":
            parts = _parts(node.multipartIdentifier())
            if len(parts) > 1 and not spark.catalog.tableExists(".".join(f"`{p}`" for p in parts)):
                raise QueryRefused("not_a_table", ".".join(parts))
        elif kind == "UnresolvedFunction" and _parts(node.nameParts())[-1].lower() in REFUSED_FUNCTIONS:
            raise QueryRefused("function", _parts(node.nameParts())[-1])
        elif kind == "UnresolvedTableValuedFunction" and _parts(node.name())[-1].lower() not in TABLE_FUNCTIONS:
            raise QueryRefused("function", _parts(node.name())[-1])


def run_select(spark: SparkSession, sql: str, max_rows: int = 1000, timeout_s: float = 10.0) -> Result:
    """Run the statement as the inside of SELECT * FROM (...) LIMIT n, which the parser
    refuses for anything but a query; its jobs are cancelled after the time limit."""
    text = validate(sql)
    group, began, late = f"adhoc-{uuid.uuid4().hex}", time.time(), threading.Event()

    def stop() -> None:
        late.set()
        spark.sparkContext.cancelJobGroup(group)

    timer = threading.Timer(timeout_s, stop)
    spark.sparkContext.setJobGroup(group, "ad-hoc query", interruptOnCancel=True)
    timer.start()
    try:
        check_reach(spark, f"SELECT * FROM (\n{text}\n)")
        df = spark.sql(f"SELECT * FROM (\n{text}\n) LIMIT {int(max_rows)}")
        rows = df.collect()  # at most max_rows
    except ParseException as e:
        raise QueryRefused("syntax", str(e).split("\n")[0]) from e
    except AnalysisException as e:
        raise QueryRefused("unknown_name" if "UNRESOLVED" in str(e) or "NOT_FOUND" in str(e) else "analysis", str(e).split("\n")[0]) from e
    except QueryRefused:
        raise
    except Exception as e:
        if "ParseException" in str(e):
            raise QueryRefused("syntax", str(e).split("\n")[0]) from e
        if late.is_set():
            raise QueryRefused("timeout", f"stopped after {timeout_s:g} s") from e
        raise
    finally:
        timer.cancel()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return Result([(f.name, f.dataType.simpleString()) for f in df.schema], rows, time.time() - began)


@dataclass
class Asker:
    """Presets and free statements, cached for a while; every attempt is logged, answers from the
    cache and failures of any kind included. `sink` gets each entry too, to append it where it
    is kept; its failure is no failure of the question."""

    spark: SparkSession
    presets: dict[str, Callable[[], DataFrame]]
    translate: Callable[[str, str], str] | None = None
    ttl_s: float = 300.0
    clock: Callable[[], float] = time.time
    sink: Callable[[dict[str, object]], None] | None = None
    log: list[dict[str, object]] = field(default_factory=list)
    _kept: dict[str, tuple[float, Result]] = field(default_factory=dict)

    def preset(self, name: str, max_rows: int = 1000) -> Result:
        """A preset by name; only successes are cached."""
        with self._noted(name) as note:
            if name not in self.presets:
                raise QueryRefused("unknown_preset", name)
            kept = self._kept.get(name)
            if kept and self.clock() - kept[0] < self.ttl_s:
                note(len(kept[1].rows), "cached")
                return Result(kept[1].columns, kept[1].rows, 0.0, True)
            began = time.time()
            df = self.presets[name]().limit(max_rows)
            result = Result([(f.name, f.dataType.simpleString()) for f in df.schema], df.collect(), time.time() - began)
            self._kept[name] = (self.clock(), result)
            note(len(result.rows))
            return result

    def sql(self, text: str, max_rows: int = 1000, timeout_s: float = 10.0) -> Result:
        """A free statement."""
        with self._noted(text) as note:
            result = run_select(self.spark, text, max_rows, timeout_s)
            note(len(result.rows))
            return result

    def question(self, text: str) -> Result:
        """A question in words, by a translator that gets the schema brief."""
        if self.translate is None:
            with self._noted(text):
                raise QueryRefused("no_translator", "no translator is set")
        try:
            statement = self.translate(schema_brief(self.spark), text)
        except Exception:
            with self._noted(text):
                raise
        return self.sql(statement)

    def ask(self, preset: str | None = None, question: str | None = None) -> Result:
        """The dispatcher: a preset by name, else a question in words; neither is refused."""
        if preset:
            return self.preset(preset)
        if question and question.strip():
            return self.question(question)
        with self._noted(""):
            raise QueryRefused("empty", "there is no question")

    @contextmanager
    def _noted(self, what: str) -> Iterator[Callable[..., None]]:
        entry: dict[str, object] = {"query": what, "outcome": "error", "rows": 0, "at": self.clock()}

        def note(rows: int, outcome: str = "ok") -> None:
            entry.update(outcome=outcome, rows=rows)

        try:
            yield note
        except QueryRefused as e:
            entry["outcome"] = e.code
            raise
        finally:
            self.log.append(entry)
            if self.sink:
                try:
                    self.sink(entry)
                except Exception:  # noqa: BLE001 - see the class
                    entry["unsaved"] = True


def log_folder(spark: SparkSession, path: str) -> Callable[[dict[str, object]], None]:
    """A sink that appends each entry to a folder of JSON files."""

    def save(entry: dict[str, object]) -> None:
        row = [(str(entry["query"]), str(entry["outcome"]), int(entry["rows"]), float(entry["at"]))]  # type: ignore[call-overload]
        spark.createDataFrame(row, "query string, outcome string, rows long, at double").write.mode("append").json(path)

    return save


def schema_brief(spark: SparkSession) -> str:
    """The tables and views of the catalog with their columns and types."""
    lines = []
    for t in sorted(spark.catalog.listTables(), key=lambda x: x.name):
        lines.append(f"{t.name}(" + ", ".join(f"{c.name} {c.dataType}" for c in spark.catalog.listColumns(t.name)) + ")")
    return "\n".join(lines)
