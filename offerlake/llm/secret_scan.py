"""Find secrets in texts by a trigram inverted index.

Every rule's regex is turned into a Boolean query over trigrams that each match must hold: the parsed pattern is read left
to right, runs of parts with few possible strings are multiplied out, each such string asks for all of its trigrams, the
alternatives are or-ed and the runs and-ed. A block of documents is indexed (trigram -> posting list of the block's
documents, for the trigrams that some query asks for), the postings are intersected and united per rule, and only the
candidates are verified with the regex. A rule without mandatory trigrams scans every document. The index is local to a
block, so nothing is shuffled, a frequent trigram costs one posting list per block, and a lost task is simply redone.

Defined cases: null text counts as empty (no spans); repeated rows give repeated results; texts are scanned whole; ids may
be null. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from offerlake.llm.common import map_text

#: Strings that one run of a pattern is multiplied out to at most.
MOST_STRINGS = 64
FOLD = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    #: The span counts only if this group has at least so many characters.
    group: int = 0
    least: int = 1


def _any_case(s: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)


#: Base rules, in the order in which spans of one start are listed (fixed values).
BASE = (
    Rule("assign", "(" + "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _any_case("api") + "_?" + _any_case("key")
         + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
#: What may stand between two lines of a key: white space, escaped line ends, quotes, marks of quoted or commented lines.
_GAP = r"""(?:\\[nrt]|//[\x20\t]|\+(?=\s)|[\s>#|*"',\\])"""
#: A private key from its BEGIN line through the END line. Without one: the header lines that say how the body is encrypted
#: and the run of base64 lines (of 16 characters or more; the last one may be shorter).
PEM = (r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----(?:[^-]*+(?:-(?!----)[^-]*+)*+-{5,}END (?:[A-Z]+ )?PRIVATE KEY-----"
       rf"|(?:{_GAP}*+(?:Proc-Type:\x20?4,ENCRYPTED|DEK-Info:\x20?[A-Z0-9-]+,[0-9A-Fa-f]+))*+"
       rf"(?:(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}+={{0,2}})++(?:(?<!=)(?:{_GAP}++[A-Za-z0-9+/]++(?:={{1,2}}|(?=[\r\n\"',\\]|\Z))|[\x20\t]++[A-Za-z0-9+/]++))?)?+)")
#: Rules the scan adds: public formats of keys and tokens (fixed values).
MORE = (
    Rule("private_key", PEM),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

# A query is a set of alternatives, each a set of trigrams that must all occur; {frozenset()} is satisfied by any text.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])


def _absorbed(alternatives: Iterable[frozenset[str]]) -> Query:
    kept: list[frozenset[str]] = []
    for a in sorted(set(alternatives), key=len):
        if not any(b <= a for b in kept):
            kept.append(a)
    return frozenset(kept)


def _both(a: Query, b: Query) -> Query:
    both = _absorbed(x | y for x in a for y in b)
    return both if len(both) <= 4 * MOST_STRINGS else min(a, b, key=len)


def _of_strings(strings: set[str]) -> Query:
    return _absorbed(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def _strings(node) -> set[str] | None:
    """All strings a parsed part can match, case-folded, or None if they are too many to list."""
    kind, arg = node
    if kind is op.LITERAL:
        return {chr(arg).lower()} if arg < 128 else None
    if kind is op.IN:
        chars: set[str] = set()
        for what, value in arg:
            if what is op.LITERAL and value < 128:
                chars.add(chr(value).lower())
            elif what is op.RANGE and value[1] < 128 and value[1] - value[0] < 8:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if kind is op.SUBPATTERN:
        return _listed(arg[3])
    if kind is op.BRANCH:
        parts = [_listed(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[1] == 1:
        inner = _listed(arg[2])
        return None if inner is None else inner | {""} if arg[0] == 0 else inner
    return {""} if kind is op.AT else None


def _listed(seq) -> set[str] | None:
    out = {""}
    for node in seq:
        s = _strings(node)
        if s is None or len(s) * len(out) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def _query(seq) -> Query:
    total, run = ANY, {""}
    for node in [*seq, None]:
        s = _strings(node) if node else None
        if s is not None and len(s) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in s}
            continue
        total, run = _both(total, _of_strings(run)), {""}
        if node is None:
            break
        kind, arg = node
        if s is not None:
            run = s
        elif kind is op.SUBPATTERN:
            total = _both(total, _query(arg[3]))
        elif kind is op.BRANCH:
            total = _both(total, _absorbed(a for p in arg[1] for a in _query(p)))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] >= 1:
            total = _both(total, _query(arg[2]))
    return total


def trigram_query(regex: str) -> Query:
    """The Boolean trigram query (or of ands) that every text with a match of ``regex`` satisfies, in lower case."""
    return _query(parser.parse(regex))


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.regex) for r in rules]
        # a run of one class that is only counted when long is sought at that length; what it matches stays the same
        self.compiled = [re.compile(f"(?<!{r.regex[:-1]}){r.regex[:-1]}{{{r.least},}}" if re.fullmatch(r"\[[^\]]+\]\+", r.regex) else r.regex) for r in rules]
        self.asked = sorted({t for q in self.queries for a in q for t in a})
        self.number = np.zeros(1 << 24, np.uint8 if len(self.asked) < 255 else np.uint16)
        for k, t in enumerate(self.asked):
            a, b, c = t.encode()
            self.number[(a << 16) | (b << 8) | c] = k + 1

    def postings(self, raw: list[bytes]) -> dict[str, np.ndarray]:
        """Trigram -> ascending numbers of the texts that hold it."""
        found: dict[str, list[np.ndarray]] = {}
        starts = np.concatenate([[0], np.cumsum([len(b) + 1 for b in raw])])
        joined = np.frombuffer(b"\x00".join(raw).translate(FOLD), np.uint8)
        step = 1 << 20
        for k in range(0, max(0, len(joined) - 2), step):
            part = joined[k:k + step + 2].astype(np.uint32)
            hit = self.number[(part[:-2] << 16) | (part[1:-1] << 8) | part[2:]]
            at = np.flatnonzero(hit)
            doc = np.searchsorted(starts, at + k, "right") - 1
            pair = np.unique(hit[at].astype(np.int64) * len(raw) + doc)
            for n in np.unique(pair // len(raw)).tolist():
                found.setdefault(self.asked[n - 1], []).append(pair[pair // len(raw) == n] % len(raw))
        return {t: np.unique(np.concatenate(v)) for t, v in found.items()}

    def candidates(self, raw: list[bytes]) -> list[np.ndarray]:
        """Per rule, the numbers of the texts that satisfy its query."""
        index, none = self.postings(raw), np.array([], np.int64)
        out = []
        for q in self.queries:
            if q == ANY:
                out.append(np.arange(len(raw)))
                continue
            united = none
            for wanted in q:
                lists = sorted((index.get(t, none) for t in wanted), key=len)
                hit = lists[0]
                for other in lists[1:]:
                    if not len(hit):
                        break
                    hit = np.intersect1d(hit, other, assume_unique=True)
                united = np.union1d(united, hit)
            out.append(united)
        return out

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text the spans (start, rule number, end), ascending."""
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, docs in enumerate(self.candidates([t.encode("utf-8", "replace") for t in texts])):
            rule, rx = self.rules[k], self.compiled[k]
            for d in docs.tolist():
                for m in rx.finditer(texts[d]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        spans[d].append((m.start(), k, m.end()))
        for s in spans:
            s.sort()
        return spans


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def scan(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """Add ``secrets``: array of (kind, start, end) by start, then by the rules' order."""

    def run(part: pa.RecordBatch) -> dict:
        texts = [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()]
        return {"secrets": [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in found] for found in scanner(rules).scan(texts)]}

    return map_text(df, text, "secrets array<struct<kind:string,start:int,end:int>>", run)


def redact(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """Replace every span by ``<kind>`` (overlapping spans by the first one's kind); a null text stays null."""

    def clean(value: str | None) -> str | None:
        if value is None:
            return None
        out, at = [], 0
        for s, k, e in scanner(rules).scan([value])[0]:
            if s >= at:
                out += [value[at:s], f"<{rules[k].kind}>"]
            at = max(at, e)
        return "".join([*out, value[at:]])

    def run(part: pa.RecordBatch) -> dict:
        texts = part.column(part.schema.get_field_index(text)).to_pylist()
        found = scanner(rules).scan([t or "" for t in texts])
        return {text: [clean(t) if f else t for t, f in zip(texts, found, strict=True)]}

    return map_text(df, text, f"`{text}` string", run).select(*[f"`{c}`" for c in df.columns])


def digests(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_assign, n_access, n_hex, base_sha256 and spans (all as kind:start:end, comma-joined); drops the text."""
    rules = BASE + MORE

    def run(part: pa.RecordBatch) -> dict:
        texts = [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()]
        found = scanner(rules).scan(texts)
        name = lambda x: f"{rules[x[1]].kind}:{x[0]}:{x[2]}"
        out: dict[str, list] = {f"n_{r.kind}": [sum(x[1] == k for x in f) for f in found] for k, r in enumerate(BASE)}
        out["base_sha256"] = [hashlib.sha256(",".join(name(x) for x in f if x[1] < len(BASE)).encode()).hexdigest() for f in found]
        out["spans"] = [",".join(map(name, f)) for f in found]
        return out

    return map_text(df, text, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", run).drop(text)
