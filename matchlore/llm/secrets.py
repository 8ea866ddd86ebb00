"""Secrets in texts: fixed patterns, and formats inferred from labelled credentials.

Three base patterns (an assignment to a telling name, access keys, long hexadecimal runs) are
found by scanning. Beside them, probabilistic automata learn what credentials look like. For every
format the labelled examples are put into a prefix tree whose states count how often they are passed, left by
each character and ended in; states whose frequencies are statistically compatible (Hoeffding bound, all the way
down) are merged, the latest settled state tried first, which turns the tree into a stochastic automaton with loops.
Ordinary strings get an automaton of their own. Every candidate, that is every maximal run of credential
characters of some length, is scored by each automaton: the log-likelihood of the format minus that of
ordinary text, per character. What reaches the limit of a format becomes a span of the likeliest one. The
limits come from labelled examples that the automata have not seen.

Labelled are ``labelled_credentials`` (drawn from written formats by a seed) and, as format ``assigned``, values that
a telling name in front of them labels in the corpus: the ``sample`` distinct ones of least hash.

Defined results: a null or empty text has no spans; positions are code points, ends exclusive; candidates that
overlap a base span are left to it; ties of formats go to the first by name; repeated rows have a row each; an empty
table still learns from the written formats.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.llm import kernels
from matchlore.llm.shared import stored

BASE = ("assign", "access", "hex")
_ASSIGN = re.compile(rb"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_STEMS = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_FILLER = re.compile(r"(.)\1{7,}", re.S)
_VALUE = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_IN_VALUE, _IN_HEX = np.zeros(256, bool), np.zeros(256, bool)
_IN_VALUE[list(_VALUE)] = True
_IN_HEX[list(b"0123456789abcdef")] = True
_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"
ORDINARY = "ordinary"

#: Public formats of credentials as (prefix, length, alphabet) parts. Alphabets: d digits, x lower-case
#: hexadecimal, U capitals and digits, w letters and digits, b base64, u base64 for urls.
FORMATS = {
    "aws_secret": [("", 40, "b")],
    "github": [("ghp_", 36, "w")],
    "gitlab": [("glpat-", 20, "u")],
    "google": [("AIza", 35, "u")],
    "jwt": [("eyJ", 33, "u"), (".eyJ", 60, "u"), (".", 43, "u")],
    "npm": [("npm_", 36, "w")],
    "sendgrid": [("SG.", 22, "u"), (".", 43, "u")],
    "slack": [("xoxb-", 12, "d"), ("-", 12, "d"), ("-", 24, "w")],
    "stripe": [("sk_live_", 24, "w")],
}
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {
    "d": _DIGITS, "x": _DIGITS + "abcdef", "U": _UPPER + _DIGITS, "w": _UPPER + _LOWER + _DIGITS,
    "b": _UPPER + _LOWER + _DIGITS + "+/", "u": _UPPER + _LOWER + _DIGITS + "_-",
}
_SYLLABLES = "an be con der el for ge ha in ka lo ment no ou pre que re sta ti un ver wo xe you zu tion ing sch eau".split()


def labelled_credentials(each: int = 200, seed: int = 42) -> dict[str, list[str]]:
    """``each`` examples of every written format, and of ordinary strings of the same characters."""
    drawn = random.Random(seed)

    def word(least: int, most: int) -> str:
        return "".join(drawn.choice(_SYLLABLES) for _ in range(drawn.randint(least, most)))

    def ordinary() -> str:
        kind = drawn.randrange(7)
        if kind == 0:
            return word(5, 9)
        if kind == 1:
            return word(5, 8).capitalize()
        if kind == 2:
            return drawn.choice("-_./").join(word(1, 4) for _ in range(drawn.randint(3, 6)))
        if kind == 3:
            return ".".join(word(2, 4) for _ in range(3)) + drawn.choice(["com", "org", "net", "html", "py"])
        if kind == 4:
            return drawn.choice(".-/").join(str(drawn.randrange(10**6)) for _ in range(drawn.randint(3, 5)))
        if kind == 5:
            return "".join(word(1, 3).capitalize() for _ in range(drawn.randint(3, 5)))
        return drawn.choice("=-_.+/") * drawn.randint(16, 60)

    found = {ORDINARY: [ordinary() for _ in range(4 * each)]}
    for name, parts in FORMATS.items():
        found[name] = [
            "".join(prefix + "".join(drawn.choices(ALPHABETS[letters], k=n)) for prefix, n, letters in parts) for _ in range(each)
        ]
    return found


@dataclass
class Automaton:
    """A stochastic automaton over characters: how often each state was passed, ended in, and left by a character."""

    passed: list[int] = field(default_factory=lambda: [0])
    ended: list[int] = field(default_factory=lambda: [0])
    left: list[dict[str, tuple[int, int]]] = field(default_factory=lambda: [{}])

    def score(self, value: str, unseen: float = 0.02, letters: int = len(_VALUE)) -> float:
        """Log-likelihood per character, mixed with the share ``unseen`` of even chances; unseen characters lead to the start."""

        def chance(n: int, state: int) -> float:
            return math.log((1 - unseen) * n / max(1, self.passed[state]) + unseen / letters)

        state, total = 0, 0.0
        for c in value:
            n, to = self.left[state].get(c, (0, 0))
            total += chance(n, state)
            state = to
        return (total + chance(self.ended[state], state)) / (len(value) + 1)


def infer(examples: list[str], alpha: float = 0.05) -> Automaton:
    """The automaton of ``examples``: compatible states of their prefix tree merged, red-blue order.

    A state is merged into the latest settled state it agrees with, which rare states most likely repeat; the
    earliest would take whatever is too rare to differ.
    """
    tree = Automaton()
    passed, ended, left = tree.passed, tree.ended, tree.left
    for value in sorted(examples):
        state = 0
        for c in value:
            passed[state] += 1
            n, to = left[state].get(c, (0, len(passed)))
            if to == len(passed):
                passed.append(0), ended.append(0), left.append({})
            left[state][c] = (n + 1, to)
            state = to
        passed[state] += 1
        ended[state] += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(a: int, n: int, b: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(a / n - b / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(red: int, blue: int) -> bool:
        """Whether ends and all characters are alike here and wherever both lead; ``blue`` heads a tree."""
        todo = [(red, blue)]
        while todo:
            a, b = todo.pop()
            if differ(ended[a], passed[a], ended[b], passed[b]):
                return False
            for c in left[a].keys() | left[b].keys():
                n, to_a = left[a].get(c, (0, -1))
                m, to_b = left[b].get(c, (0, -1))
                if differ(n, passed[a], m, passed[b]):
                    return False
                if to_a >= 0 and to_b >= 0:
                    todo.append((to_a, to_b))
        return True

    def merge(red: int, blue: int) -> None:
        """Adds the tree below ``blue`` to the automaton at ``red``."""
        todo = [(red, blue)]
        while todo:
            a, b = todo.pop()
            passed[a] += passed[b]
            ended[a] += ended[b]
            for c, (m, to_b) in left[b].items():
                if c in left[a]:
                    n, to_a = left[a][c]
                    left[a][c] = (n + m, to_a)
                    todo.append((to_a, to_b))
                else:
                    left[a][c] = (m, to_b)

    reds = [0]
    blues = [(0, c) for c in sorted(left[0])]
    settled = {0}
    while blues:
        parent, c = blues.pop(0)
        n, blue = left[parent][c]
        if blue in settled:
            continue
        for red in reversed(reds):
            if compatible(red, blue):
                left[parent][c] = (n, red)
                merge(red, blue)
                break
        else:
            reds.append(blue)
            settled.add(blue)
        # a merge may have hung new trees below red states
        blues = [(r, c) for r in reds for c in sorted(left[r]) if left[r][c][1] not in settled]
    place = {state: i for i, state in enumerate(reds)}
    return Automaton(
        [passed[r] for r in reds], [ended[r] for r in reds],
        [{c: (n, place[to]) for c, (n, to) in left[r].items()} for r in reds],
    )


@dataclass
class Formats:
    """An automaton per format, the limit of each, and the automaton of ordinary strings."""

    ordinary: Automaton
    automata: dict[str, Automaton]
    limits: dict[str, float]
    lengths: dict[str, tuple[int, int]]

    def margin(self, name: str, value: str) -> float:
        """How much likelier than ordinary text, per character."""
        return self.automata[name].score(value) - self.ordinary.score(value)

    def best(self, value: str) -> str | None:
        """The likeliest format among those whose limit the value reaches, or none.

        Runs of eight or more equal characters count as one, which fillers and rulers then are too short for;
        a value may be up to twice as long as the longest example.
        """
        value = _FILLER.sub(r"\1", value)
        fitting = [n for n, (least, most) in sorted(self.lengths.items()) if least <= len(value) <= 2 * most]
        found = [(self.margin(n, value), n) for n in fitting]
        return max(((m, n) for m, n in found if m >= self.limits[n]), key=lambda f: f[0], default=(0, None))[1]


def learned(examples: dict[str, list[str]], alpha: float = 0.05, pass_: float = 0.02, seed: int = 42) -> Formats:
    """Automata of all formats in ``examples``; every third example is held out and sets the limit.

    A limit lies where all but the share ``pass_`` of the held-out credentials pass, but above all held-out ordinary strings.
    """
    fit, held = {}, {}
    for name, values in examples.items():
        values = sorted(values)
        random.Random(seed).shuffle(values)
        held[name] = values[::3]
        fit[name] = [v for i, v in enumerate(values) if i % 3] or values
    formats = Formats(infer(fit[ORDINARY], alpha), {n: infer(v, alpha) for n, v in fit.items() if n != ORDINARY and v}, {}, {})
    for name in formats.automata:
        good = sorted(formats.margin(name, v) for v in held[name])
        bad = max((formats.margin(name, v) for v in held[ORDINARY]), default=0.0)
        low = good[int(len(good) * pass_)]
        formats.limits[name] = max((low + bad) / 2, bad + 1e-9) if low > bad else math.nextafter(bad, math.inf)
        formats.lengths[name] = min(map(len, examples[name])), max(map(len, examples[name]))
    return formats


def _runs(flags: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``flags`` of at least ``least``; none crosses texts."""
    cut = np.zeros(len(flags) + 1, bool)
    cut[offsets] = True
    first, last = flags.copy(), flags.copy()
    first[1:] &= ~flags[:-1] | cut[1:-1]
    last[:-1] &= ~flags[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def found_in(data: np.ndarray, offsets: np.ndarray, shortest: int) -> list[list[tuple[str, int, int, str]]]:
    """Base spans and, as kind '', the candidates of each text of a piece, by code points.

    The value of an assignment is what is assigned, of a candidate the run itself.
    """
    rows = len(offsets) - 1
    spans: list[list[tuple[str, int, int, str]]] = [[] for _ in range(rows)]
    raw: list[list[tuple[str, int, int, bytes]]] = [[] for _ in range(rows)]
    for kind, flags, least in (("hex", _IN_HEX, 16), ("", _IN_VALUE, shortest)):
        starts, ends = _runs(flags[data], offsets, least)
        for r, s, e in zip((np.searchsorted(offsets, starts, "right") - 1).tolist(), starts.tolist(), ends.tolist()):
            at = int(offsets[r])
            raw[r].append((kind, s - at, e - at, b"" if kind else data[s:e].tobytes()))
    for r in range(rows):
        text = data[offsets[r] : offsets[r + 1]].tobytes()
        lower = text.lower()
        if any(stem in lower for stem in _STEMS):
            raw[r] += [("assign", *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
        if b"AKIA" in text:
            raw[r] += [("access", *m.span(), b"") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
        if raw[r]:
            # code points before each byte
            upto = np.concatenate([[0], np.cumsum(data[offsets[r] : offsets[r + 1]] >> 6 != 0b10)])
            spans[r] = [(k, int(upto[s]), int(upto[e]), v.decode()) for k, s, e, v in raw[r]]
    return spans


def scanned(text: str | Column = "text", shortest: int = 16) -> Column:
    """Base spans and candidates (kind '') of a text column."""

    @F.arrow_udf(f"array<{_SPAN}>")
    def of(texts: pa.Array) -> pa.Array:
        rows: list[list[tuple[str, int, int, str]]] = []
        for _, _, data, offsets in kernels.pieces(texts):
            rows += found_in(data, offsets, shortest)
        names = ("kind", "start", "end", "value")
        fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]
        return pa.array([[dict(zip(names, s)) for s in r] for r in rows], pa.list_(pa.struct(fields)))

    return of(text)


def corpus_credentials(found: DataFrame, sample: int = 500, longest: int = 256) -> list[str]:
    """Up to ``sample`` distinct assigned values of at most ``longest`` characters, those of least hash."""
    values = found.select(F.explode("found").alias("s")).where(
        (F.col("s.kind") == "assign") & (F.length("s.value") <= longest)
    ).select(F.col("s.value").alias("value")).distinct()
    return [r["value"] for r in values.orderBy(F.md5("value"), "value").limit(sample).collect()]


def judged(found: DataFrame, formats: Formats) -> DataFrame:
    """``found`` with spans: base spans, and the candidates beside them that some automaton accepts."""
    shared = found.sparkSession.sparkContext.broadcast(formats)

    @F.arrow_udf(f"array<{_SPAN}>")
    def accept(column: pa.Array) -> pa.Array:
        model, rows, known = shared.value, [], {}
        for spans in column.to_pylist():
            base = sorted((s["start"], s["end"]) for s in spans if s["kind"])
            kept = [s for s in spans if s["kind"]]
            reach, at = -1, 0
            for s in sorted((s for s in spans if not s["kind"]), key=lambda s: s["start"]):
                while at < len(base) and base[at][0] < s["end"]:
                    reach, at = max(reach, base[at][1]), at + 1
                if reach > s["start"]:
                    continue
                value = s["value"]
                if value not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[value] = model.best(value)
                if known[value]:
                    kept.append(s | {"kind": known[value]})
            rank = {k: i for i, k in enumerate(BASE)}
            rows.append(sorted(kept, key=lambda s: (s["start"], rank.get(s["kind"], len(rank)), s["kind"])))
        return pa.array(rows, column.type)

    return found.withColumn("found", accept("found"))


def secret_spans(docs: DataFrame, shortest: int = 16, sample: int = 500, alpha: float = 0.05) -> DataFrame:
    """doc_id and found: an array of (kind, start, end, value) by start, then kind, of every document."""
    found = stored(docs.select("doc_id", scanned("text", shortest).alias("found")), "secret-candidates")
    examples = labelled_credentials()
    # a format needs examples on both sides of the held-out cut
    values = corpus_credentials(found, sample)
    if len(values) >= 30:
        examples["assigned"] = values
    return judged(found, learned(examples, alpha))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the base kinds, the digest of base spans, and all spans as ``kind:start:end``."""
    found = secret_spans(docs)

    def of(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s.kind == kind)).cast("bigint")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    base = F.filter("found", lambda s: s.kind.isin(*BASE))
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
    )
