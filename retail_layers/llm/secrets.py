"""Secret scans with one deterministic automaton for all rules.

Every rule's regular expression becomes a small nondeterministic automaton; subset
construction and minimisation turn all of them together into one transition array over
byte classes, with a bit per rule on each state. A batch of texts is scanned in one pass
over its bytes: the bytes lie in many lanes that advance side by side, and a lane that did
not begin in the state its predecessor ended in is run again until both agree. So a text of
any length is scanned in pieces of fixed size, and nothing is cut.

An accepting stretch gives the end of a match; its start follows from the rule. Matches of
a kind are leftmost and do not overlap; those that are too short are dropped afterwards.

Defined cases: a missing text counts as empty and has no span; repeated rows give repeated
results; offsets count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
INNER = re.compile(b"(?i:password|passwd|secret|token|api_?key)=[A-Za-z0-9+/_.=-]")
VALUE = "[A-Za-z0-9+/_.=-]"


@dataclass(frozen=True)
class Rule:
    """``regex`` is what the automaton accepts; ``lead`` how long a match is at its first accepted end."""

    kind: str
    regex: str
    lead: int = 0
    any_case: bool = False


# The kinds, their patterns and least lengths; the last two are additions.
RULES = (
    Rule("assign", "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?" + VALUE + "+", any_case=True),
    Rule("access", "AKIA[A-Z0-9]{12,}", 16),
    Rule("hex", "[0-9a-f]{32,}", 32),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 15),
)
BASE = 3
LEAST_VALUE = 8
LANE, PIECE = 256, 1 << 22
RESULT = "n_assign bigint, n_access bigint, n_hex bigint, base string, spans string"


class Fragments:
    """A nondeterministic automaton: byte edges, empty edges and a parser that builds them."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def rule(self, regex: str, any_case: bool) -> tuple[int, int]:
        self.regex, self.at, self.any_case = regex, 0, any_case
        return self._alternatives()

    def _peek(self) -> str:
        return self.regex[self.at] if self.at < len(self.regex) else ""

    def _alternatives(self) -> tuple[int, int]:
        first, last = self.state(), self.state()
        while True:
            a, b = self._sequence()
            self.empty[first].append(a)
            self.empty[b].append(last)
            if self._peek() != "|":
                return first, last
            self.at += 1

    def _sequence(self) -> tuple[int, int]:
        first = last = self.state()
        while self._peek() not in ("", "|", ")"):
            begin = self.at
            part = self._atom()
            low, high = self._count()
            end = self.at
            for k in range(max(low, high or 0, 1)):
                if k:  # another copy of the same atom
                    self.at = begin
                    part = self._atom()
                a, b = part
                self.empty[last].append(a)
                if high is None and k == max(low, 1) - 1:
                    self.empty[b].append(a)
                if k >= low:
                    self.empty[a].append(b)
                last = b
            self.at = end
        return first, last

    def _count(self) -> tuple[int, int | None]:
        """How often the atom just read occurs: least and most (None: without bound)."""
        ch = self._peek()
        if ch and ch in "?*+":
            self.at += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[ch]
        if ch != "{":
            return 1, 1
        end = self.regex.index("}", self.at)
        low, comma, high = self.regex[self.at + 1:end].partition(",")
        self.at = end + 1
        return int(low), (int(high) if high else None) if comma else int(low)

    def _byte(self) -> int:
        ch = self.regex[self.at]
        self.at += 1
        if ch != "\\":
            return ord(ch)
        ch = self.regex[self.at]
        self.at += 1
        if ch != "x":
            return ord(ch)
        self.at += 2
        return int(self.regex[self.at - 2:self.at], 16)

    def _atom(self) -> tuple[int, int]:
        ch = self._peek()
        if ch == "(":
            self.at += 1
            part = self._alternatives()
            self.at += 1
            return part
        chosen = set()
        if ch == "[":
            self.at += 1
            while self._peek() != "]":
                low = high = self._byte()
                if self._peek() == "-" and self.regex[self.at + 1] != "]":
                    self.at += 1
                    high = self._byte()
                chosen |= set(range(low, high + 1))
            self.at += 1
        else:
            chosen = {self._byte()}
        if self.any_case:
            chosen |= {ord(f(chr(b))) for b in chosen if chr(b).isalpha() for f in (str.lower, str.upper)}
        a, b = self.state(), self.state()
        self.edges[a].append((frozenset(chosen), b))
        return a, b


@dataclass
class Automaton:
    """``step[state * n + class]`` is the next state times n; ``accept`` has the rules' bits at state * n."""

    byte_class: np.ndarray
    n_classes: int
    step: np.ndarray
    accept: np.ndarray
    n_states: int

    def states(self, classes: np.ndarray, begin: int) -> np.ndarray:
        """The state (times n) after each of the classes, begun in ``begin``."""
        n = len(classes)
        lanes = -(-n // LANE)
        padded = np.zeros(lanes * LANE, np.int32)
        padded[:n] = classes
        padded = np.ascontiguousarray(padded.reshape(lanes, LANE).T)
        out = np.empty((LANE, lanes), np.int32)
        now = np.zeros(lanes, np.int32)
        now[0] = begin
        for i in range(LANE):
            now = self.step[now + padded[i]]
            out[i] = now
        assumed = np.zeros(lanes, np.int32)
        assumed[0] = begin
        while True:
            came = np.r_[np.int32(begin), out[-1, :-1]]
            lane = np.flatnonzero(came != assumed)
            if not len(lane):
                return out.T.ravel()[:n]
            now = assumed[lane] = came[lane]
            for i in range(LANE):
                now = self.step[now + padded[i, lane]]
                other = now != out[i, lane]
                lane, now = lane[other], now[other]
                if not len(lane):
                    break
                out[i, lane] = now


def build(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """All rules in one minimal deterministic automaton that looks for them everywhere."""
    nfa = Fragments()
    parts = [nfa.rule(r.regex, r.any_case) for r in rules]
    goal = {end: 1 << k for k, (_, end) in enumerate(parts)}

    # bytes that no rule tells apart form a class; class 0 is the border between texts
    tests = sorted({s for row in nfa.edges for s, _ in row}, key=sorted)
    kinds: dict[tuple[bool, ...], int] = {}
    byte_class = np.zeros(256, np.int32)
    for b in range(256):
        byte_class[b] = 1 + kinds.setdefault(tuple(b in t for t in tests), len(kinds))
    n = 1 + len(kinds)
    sample = {c: int(np.flatnonzero(byte_class == c)[0]) for c in range(1, n)}
    moves = [[(frozenset(c for c in range(1, n) if sample[c] in s), to) for s, to in row] for row in nfa.edges]

    def closed(state: int) -> int:
        """The states reached from one without a byte, as bits."""
        todo, seen = [state], {state}
        while todo:
            for to in nfa.empty[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return sum(1 << s for s in seen if nfa.edges[s] or s in goal)

    closures = [closed(s) for s in range(len(nfa.edges))]
    root = 0
    for a, _ in parts:
        root |= closures[a]
    known, order, rows = {root: 0}, [root], []
    for current in order:  # grows while it is walked
        row, left = [root] * n, current
        while left:
            low = left & -left
            left ^= low
            for classes, to in moves[low.bit_length() - 1]:
                for c in classes:
                    row[c] |= closures[to]
        for c, nxt in enumerate(row):
            if nxt not in known:
                known[nxt] = len(order)
                order.append(nxt)
            row[c] = known[nxt]
        rows.append(row)
    table = np.array(rows)
    accept = np.array([sum(bit for s, bit in goal.items() if states >> s & 1) for states in order])

    # minimisation: split classes of states until successors agree
    block = np.unique(accept, return_inverse=True)[1]
    weight = np.random.default_rng(8).integers(1, 1 << 62, n + 1)
    while True:
        finer = np.unique(block * weight[n] + (block[table] * weight[:n]).sum(1), return_inverse=True)[1]
        if finer.max() == block.max():
            break
        block = finer
    size = block.max() + 1
    first = np.full(size, -1)
    first[block[::-1]] = np.arange(len(block))[::-1]
    number = np.argsort(np.argsort(first))  # the root keeps number 0
    small, flags = np.zeros((size, n), np.int32), np.zeros((size, n), np.uint8)
    small[number] = number[block[table[first]]] * n
    flags[number, 0] = accept[first]
    return Automaton(byte_class, n, small.ravel(), flags.ravel(), size)


def _assign_start(raw: bytes, value: int) -> int | None:
    """Where the assignment whose value begins at ``value`` begins."""
    at = value
    if raw[at - 1:at] in (b'"', b"'"):
        at -= 1
    at = len(raw[:at].rstrip(b" ")) if raw[at - 1:at] == b" " else at
    if raw[at - 1:at] not in (b":", b"="):
        return None
    at -= 1
    at = len(raw[:at].rstrip(b" ")) if raw[at - 1:at] == b" " else at
    if raw[at - 1:at] in (b'"', b"'"):
        at -= 1
    tail = raw[max(0, at - 8):at].lower()
    return next((at - len(k) for k in KEYWORDS if tail.endswith(k)), None)


def _spans(raw: bytes, ends: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """(rule, start, end) in bytes from the accepted stretches (first, last end) of one text."""
    found = []
    for k, stretches in ends.items():
        done = 0
        for first, last in stretches:
            kind = RULES[k].kind
            if kind == "assign":
                start = _assign_start(raw, first)
            elif kind == "pem":
                start = raw.rfind(b"-----BEGIN ", 0, first)
            else:
                start = first + 1 - RULES[k].lead
            if kind == "assign" and start is not None and start < done:
                # begins inside the match before it; another may begin inside the value
                inner = INNER.search(raw, first, last + 1)
                start, first = (inner.start(), inner.end() - 1) if inner else (None, first)
            if start is None or start < done:
                continue
            done = last + 1
            if kind != "assign" or last + 1 - first >= LEAST_VALUE:
                found.append((k, start, last + 1))
    return found


def scan(texts: list[str | None], dfa: Automaton) -> list[list[tuple[int, int, int]]]:
    """For each whole text its spans (rule, start, end) in code points, by start and then by rule."""
    raws = [(t or "").encode("utf-8", "replace") for t in texts]
    ends: list[dict[int, list[tuple[int, int]]]] = [{} for _ in raws]
    state = 0
    for doc, at, classes in _pieces(raws, dfa):
        states = dfa.states(classes, state)
        state = int(states[-1])
        flags = dfa.accept[states]
        hits = np.flatnonzero(flags)
        if not len(hits):
            continue
        for k in range(len(RULES)):
            pos = hits[(flags[hits] >> k) & 1 == 1]
            if not len(pos):
                continue
            cut = np.flatnonzero(np.diff(pos) > 1)
            for lo, hi in zip(pos[np.r_[0, cut + 1]].tolist(), pos[np.r_[cut, len(pos) - 1]].tolist()):
                j = int(np.searchsorted(at, lo, side="right")) - 1
                shift = doc[j][1] - int(at[j])
                held = ends[doc[j][0]].setdefault(k, [])
                if held and held[-1][1] + 1 == lo + shift:  # goes on from the piece before
                    held[-1] = (held[-1][0], hi + shift)
                else:
                    held.append((lo + shift, hi + shift))
    out = []
    for raw, by_rule in zip(raws, ends):
        spans = _spans(raw, by_rule) if by_rule else []
        if spans:
            points = np.r_[0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)]
            spans = sorted((k, int(points[s]), int(points[e])) for k, s, e in spans)
            spans.sort(key=lambda x: (x[1], x[0]))
        out.append(spans)
    return out


def _pieces(raws: list[bytes], dfa: Automaton) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Byte classes of about ``PIECE`` bytes at a time, with (text, offset) and place of each stretch in it."""
    doc, at, parts, size = [], [], [], 0
    border = np.zeros(1, np.int32)
    for k, raw in enumerate(raws):
        for begin in range(0, max(len(raw), 1), PIECE):
            chunk = np.frombuffer(raw[begin:begin + PIECE], np.uint8)
            lead = [] if begin else [border]
            doc.append((k, begin))
            at.append(size + len(lead))
            parts += [*lead, dfa.byte_class[chunk]]
            size += len(chunk) + len(lead)
            if size >= PIECE:
                yield doc, np.array(at), np.concatenate(parts)
                doc, at, parts, size = [], [], [], 0
    if size:
        yield doc, np.array(at), np.concatenate(parts)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{RULES[k].kind}:{s}:{e}" for k, s, e in spans)


def find(text: Column) -> Column:
    """A struct per text: counts of the base kinds, base spans and all spans as text."""

    dfa = build()

    @F.pandas_udf(RESULT)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for spans in scan(list(texts), dfa):
            base = [x for x in spans if x[0] < BASE]
            rows.append((*(sum(k == x[0] for x in base) for k in range(BASE)), listed(base), listed(spans)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])

    return found.asNondeterministic()(text)


def redact(text: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""

    dfa = build()

    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(texts, scan(list(texts), dfa)):
            if spans:
                parts, done = [], 0
                for k, start, end in spans:
                    if start >= done:
                        parts += [t[done:start], f"[{RULES[k].kind}]"]
                    done = max(done, end)
                t = "".join([*parts, t[done:]])
            out.append(t)
        return pd.Series(out, dtype=object)

    return redacted.asNondeterministic()(text)


def digest(listing: str) -> str:
    return hashlib.sha256(listing.encode()).hexdigest()
