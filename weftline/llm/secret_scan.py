"""Secrets by one deterministic automaton for all rules.

The rules' full regexes are compiled to one minimal automaton over bytes; it reads each text once and gives the ends of all matches, and the rule's reversed automaton gives their starts. No other matcher runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.automaton import Automaton, compile_rules
from weftline.llm.common import text_of


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its regex, and the least length of a match: of all of it, or only of its last part (`tail`), which begins with the character that first fulfils the regex. Matches that are shorter are dropped after they have taken their characters."""

    kind: str
    pattern: str
    least: int = 1
    tail: bool = False


_KEYWORD = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))

BASE = (
    Rule("assign", f"({_KEYWORD})[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+", 6, tail=True),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    # a run of these characters is one match, so its least length can be counted by the automaton
    Rule("hex", "[0-9a-f]{24}[0-9a-f]*"),
)
MORE = (
    Rule("github", "gh[opsur]_[A-Za-z0-9]+", 24),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 30),
)
RULES = BASE + MORE

SCHEMA = "_id {id}, spans array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@lru_cache
def automaton_of(rules: tuple[Rule, ...]) -> Automaton:
    return compile_rules([r.pattern for r in rules])


def scan_text(text: str, automaton: Automaton, rules: tuple[Rule, ...]) -> list[dict]:
    """The spans of one text by start, then as the rules are listed; in code points, end exclusive."""
    data = text.encode("utf-8", "surrogatepass")
    spans = [(s, k, e) for s, k, e, first in automaton.spans(data) if e - (first - 1 if rules[k].tail else s) >= rules[k].least]
    if not spans:
        return []
    if len(data) == len(text):
        at = {}
    else:  # matches are ASCII, so only what comes before them shifts them
        at, chars, done = {}, 0, 0
        for place in sorted({p for s, _, e in spans for p in (s, e)}):
            chars += len(data[done:place].decode("utf-8", "surrogatepass"))
            at[place], done = chars, place
    return [{"kind": rules[k].kind, "start": at.get(s, s), "end": at.get(e, e)} for s, k, e in spans]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """_id and spans (kind, start, end; code points, end exclusive, by start, then as the rules are listed) of every row.

    Rows stay where they are: no shuffle. The automaton has a fixed size that follows from the rules alone.

    Cases: null texts are empty and have no spans; very long texts are read whole; repeated rows, null ids and empty tables pass through; other columns are not touched.
    """
    automaton = automaton_of(rules)
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [scan_text(t, automaton, rules) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, type=_SPANS)], ["_id", "spans"])

    return rows.mapInArrow(scan, SCHEMA.format(id=docs.schema[id_col].dataType.simpleString()))
