"""Personal data by candidate gradient boosting, in DataFrame functions only.

*Base kinds* (email, ip, card, phone) are patterns with checks; their spans
always stand. Beside them, *generators* of high recall propose overlapping
candidate spans of any form a person might write: mail-like, number-like and
key-like runs. A candidate is described by a few small counts of its format and
of the words before it. Boosted trees score it, and a threshold per generator,
calibrated on candidates the trees have not seen, selects it.

No table has labels for personal data, so the trees learn from *constructed*
examples (``examples``): values of many shapes, set into contexts of which some
ask for them (a cue before a key or a number) and others do not (a commit, an
order, a file). The label is what the example was made as; the features see only
the text. The same shapes stand on both sides, so neither shape nor cue tells
alone. Half of the examples, by a hash, fit the trees, the other half calibrate
and measure them (``quality_by_generator``). The examples are a fixed number of
rows made in Spark, summed by feature vector; the sums, at most ``VECTORS``,
are what the boosting loop, plain Python, reads. The trees go back to Spark as
one SQL expression, and every text is judged by them.

Places are code points. They come from splitting a text at a pattern: the
lengths of the pieces and of the matches add up to the place of each match.
All of it happens in a document's row; there is no shuffle, and the work follows
the length of a text, however many matches it holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone", "secret"]  # in the order of results

# The base patterns. Possessive, and started only where a match can start, so
# that no text takes more than linear time; what they match is unchanged.
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts without a match of these have none of the pattern either.
_GATE = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

# Generators: name, kind proposed, pattern, gate. Their spans may overlap: where
# numbers stand side by side, the base patterns read them as one and drop it.
GENERATORS = [
    ("mail", "email",
     r"(?:\G|(?<![^\s<>\[\](),;:]))[^\s<>\[\](),;:@]++\x20?(?:@|\((?:at|AT)\)|\[(?:at|AT)\])\x20?[A-Za-z0-9][A-Za-z0-9.-]*+",
     r"@|\((?:at|AT)\)|\[(?:at|AT)\]"),
    ("number", "phone", r"(?:\G|(?<![0-9A-Za-z]))[+(]?[0-9][0-9\x20().-]{5,}[0-9](?![0-9A-Za-z])", "[0-9]"),
    ("dialled", "phone", r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20.-][0-9]{2,4}){1,4}(?![0-9])", r"\+[0-9]"),
    ("grouped", "card", r"(?<![0-9])(?:[0-9]{4}[\x20-]?){3}[0-9]{4}(?![0-9])", "[0-9]{4}"),
    # with a digit and a letter in it: a run of one kind is a word or a number
    ("key", "secret", r"(?:\G|(?<![A-Za-z0-9+/_-]))(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{12,}+(?![A-Za-z0-9+/_@-])",
     "[0-9]"),
]
# A text without a match of this has no base span and no candidate.
_ANY = r"[0-9@]|\((?:at|AT)\)|\[(?:at|AT)\]"
VECTORS = 20_000
EXAMPLES = 20_000  # constructed rows that the trees learn from
CONTEXT = 24  # code points before a candidate that its features see
LEAST_RUN = 16  # values that one fold puts together, at least
BLOCK = 256  # code points of a piece of text that substrings are taken from
_CUES = {
    "cue_key": "(?i)(?:pass(?:word|wd)?|pwd|token|secret|api|key)[\x20\"'_-]*$|(?i)(?:pass(?:word|wd)?|pwd|token|secret|key)[\x20]*[=:][\x20]*[\"']?$",
    "cue_call": "(?i)(?:tel|phone|fax|mobile|call|ruf|tél|telefon)[.:\x20]*$",
    "cue_sign": "[=:][\x20]*[\"']?$",
}


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The sums or maxima (``join``, from 0 on) of an array of bigint up to each
    place. A fold copies the array it builds, so one over n values would copy n * n.
    Runs of values are folded by themselves, each from the total of the runs before
    it; with runs as long as the cube root of 2 n, some n ** (4/3) are copied."""
    zero = F.lit(0).cast("long")

    def folded(part: Column, first: Column) -> Column:
        def step(acc: Column, v: Column) -> Column:
            at = join(acc["at"], v)
            return F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))
        start = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(part, start, step, lambda acc: acc["out"])

    def put_together(runs: Column) -> Column:
        totals = folded(F.transform(runs, lambda run: F.aggregate(run, zero, join)), zero)
        return _bound(totals, lambda t: F.flatten(F.transform(runs, lambda run, i: folded(run, F.coalesce(F.get(t, i - 1), zero)))))

    def runs_of(array: Column) -> Column:
        length = F.greatest(F.lit(LEAST_RUN), F.ceil(F.cbrt(2 * F.size(array))).cast("int"))
        return _bound(length, lambda k: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(array) - 1) / k).cast("int")), lambda i: F.slice(array, i * k + 1, k)))

    return _bound(_bound(values, runs_of), put_together)


def _tops(spans: Column) -> Column:
    """The largest end up to each of the spans."""
    return _running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))


def _blocks(text: Column) -> Column:
    """The text in pieces of ``BLOCK`` code points. A substring of a text is found by
    walking there from its begin; within a block the way is short."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _part(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from start up to end of the text that ``blocks`` hold."""
    first, last = (F.floor(at / BLOCK).cast("int") for at in (start, end))
    return F.substring(F.array_join(F.slice(blocks, first + 1, last - first + 1), ""), (start % BLOCK + 1).cast("int"), (end - start).cast("int"))


def matches(text: Column, patterns: list[tuple[str, str]]) -> Column:
    """All matches of every (pattern, gate), leftmost first: an array per pattern of
    (start, end, value)."""
    kind = "array<struct<start:bigint,end:bigint,value:string>>"
    cuts = F.array(*(F.when(text.rlike(gate), F.struct(
        F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")))
        for pattern, gate in patterns))

    def placed(c: Column) -> Column:
        steps = F.transform(c["found"], lambda v, i: (F.length(F.get(c["pieces"], i)) + F.length(v)).cast("long"))
        return _bound(_running(steps, lambda a, b: a + b), lambda ends: F.transform(c["found"], lambda v, i: F.struct(
            (F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value"))))

    return F.transform(cuts, lambda c: F.when(F.size(c["found"]) > 0, placed(c)).otherwise(F.array().cast(kind)))


def luhn(digits: Column) -> Column:
    """The check sum of a card number."""
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, 1).cast("int")
        return acc + F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


_CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": lambda v: F.when(F.length(_digits(v)).between(12, 19), luhn(_digits(v))).otherwise(False),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def _base_spans(found: Column) -> Column:
    """The checked matches of the base patterns, as sorted (start, kind, end)."""
    def of(k: int, kind: str) -> Column:
        checked = F.filter(F.get(found, F.lit(k)), lambda m: _CHECKS[kind](m["value"]))
        return F.transform(checked, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))
    return F.array_sort(F.concat(*(of(k, kind) for k, kind in enumerate(BASE))))


# Candidates ---------------------------------------------------------------


def _level(value: Column, *edges: int) -> Column:
    """How many of the edges the value reaches."""
    return sum(((value >= e).cast("int") for e in edges[1:]), (value >= edges[0]).cast("int"))


def features(generator: Column, value: Column, before: Column) -> dict[str, Column]:
    """Small counts that describe a candidate: format first, then context."""
    length, digits = F.length(value), F.length(_digits(value))
    letters = F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    return {
        "generator": generator,
        "length": _level(length, 8, 12, 16, 20, 30, 40),
        "digits": _level(digits, 1, 4, 7, 9, 12, 16, 20),
        "letters": _level(letters, 1, 4, 8, 16),
        "separators": _level(length - digits - letters, 1, 2, 4, 6),
        "domain": value.rlike(r"(?:@|\)|\])\x20?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$").cast("int"),
        "plus": value.startswith("+").cast("int") + 2 * value.startswith("(").cast("int"),
        "mixed": value.rlike("^[A-Z]{4}[0-9A-Z]{12,}$").cast("int") + 2 * value.rlike("^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,}$").cast("int"),
        "checked": F.when(digits.between(12, 19), luhn(_digits(value))).otherwise(False).cast("int"),
        "switches": _level(F.length(F.regexp_replace(F.regexp_replace(value, "[A-Za-z]+", "a"), "[0-9]+", "0")), 3, 6, 10),
        **{cue: before.rlike(p).cast("int") for cue, p in _CUES.items()},
    }


FEATURES = ["generator", "length", "digits", "letters", "separators", "domain", "plus", "mixed", "checked", "switches", *_CUES]


def _candidates(text: Column, found: Column) -> Column:
    """The matches of all generators, described by their features."""
    kinds = F.array(*(F.lit(KINDS.index(kind)) for _, kind, *_ in GENERATORS))
    proposed = F.flatten(F.transform(found, lambda ms, g: F.transform(
        ms, lambda m: F.struct(g.alias("generator"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))))

    def with_context(ms: Column) -> Column:
        return _bound(_blocks(text), lambda blocks: F.transform(ms, lambda m: F.struct(
            m["generator"].alias("generator"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"),
            _part(blocks, F.greatest(m["start"] - CONTEXT, F.lit(0)), m["start"]).alias("before"))))

    return F.transform(_bound(proposed, with_context), lambda m: F.struct(
        m["start"].alias("start"), F.get(kinds, m["generator"]).alias("kind"), m["end"].alias("end"),
        *(c.cast("int").alias(n) for n, c in features(m["generator"], m["value"], m["before"]).items())))


def candidates(text: Column) -> Column:
    """Candidate spans of all generators with their features."""
    return _bound(matches(text, [g[2:] for g in GENERATORS]), lambda found: _candidates(text, found))


_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _overlaps_any(c: Column, spans: Column, tops: Column) -> Column:
    """Whether ``c`` overlaps one of the sorted spans: of those that start before its
    end, found by halving, the largest end lies behind its start."""
    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        before = F.get(spans, middle)["start"] < c["end"]
        return F.when(acc["low"] >= acc["high"], acc).otherwise(F.struct(
            F.when(before, middle + 1).otherwise(acc["low"]).alias("low"), F.when(before, acc["high"]).otherwise(middle).alias("high")))

    whole = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    halvings = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    searched = F.aggregate(halvings, whole, halve, lambda acc: F.coalesce(F.get(tops, acc["low"] - 1), F.lit(0)) > c["start"])
    return F.when(F.size(spans) > 0, searched).otherwise(False)


def spans_and_candidates(text: Column) -> Column:
    """(base, candidates) of a text in one struct; null where it has neither."""
    patterns = [(BASE[k], _GATE[k]) for k in BASE] + [g[2:] for g in GENERATORS]
    return F.when(text.rlike(_ANY), _bound(matches(text, patterns), lambda found: F.struct(
        _base_spans(found).alias("base"),
        _candidates(text, F.slice(found, len(BASE) + 1, len(GENERATORS))).alias("candidates"))))


def _described(rows: DataFrame, *kept: str) -> DataFrame:
    """``rows`` (with text) and their base spans and candidates, as arrays."""
    found = rows.select(*kept, spans_and_candidates(F.coalesce("text", F.lit(""))).alias("found"))
    return found.select(*kept, F.coalesce("found.base", F.array().cast(_SPANS)).alias("base"), F.col("found.candidates").alias("candidates"))


def described(docs: DataFrame) -> DataFrame:
    """doc_id, text, base (array of spans) and candidates of every document."""
    return _described(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", "text")


# Boosting -----------------------------------------------------------------


@dataclass
class Model:
    """Boosted trees of depth two over small counts, and a threshold per generator."""

    trees: list[tuple] = field(default_factory=list)
    bias: float = 0.0
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, x: dict[str, int]) -> float:
        return self.bias + sum(_leaf(t, x) for t in self.trees)

    def sql(self, c: Column) -> Column:
        """The score of a candidate struct as one expression."""
        out = F.lit(float(self.bias))
        for (f, cut, left, right) in self.trees:
            side = [F.when(c[g] >= at, F.lit(hi)).otherwise(F.lit(lo)) for g, at, lo, hi in (left, right)]
            out = out + F.when(c[f] >= cut, side[1]).otherwise(side[0])
        return out

    def selects(self, c: Column) -> Column:
        threshold = F.lit(float("inf"))
        for g, least in self.thresholds.items():
            threshold = F.when(c["generator"] == g, F.lit(least)).otherwise(threshold)
        return self.sql(c) >= threshold


def _leaf(tree: tuple, x: dict[str, int]) -> float:
    f, cut, left, right = tree
    g, at, lo, hi = right if x[f] >= cut else left
    return hi if x[g] >= at else lo


def _best_split(cells: list[tuple], names: list[str]) -> tuple[float, str, int, float, float]:
    """The split of (x, gradient, hessian) cells with the largest gain:
    gain, feature, cut, value below, value from the cut on."""
    total_g, total_h = sum(g for _, g, _ in cells), sum(h for _, _, h in cells)
    best = (-1.0, names[0], 1 << 30, total_g / (total_h + 1), 0.0)
    for name in names:
        by: dict[int, list[float]] = {}
        for x, g, h in cells:
            s = by.setdefault(x[name], [0.0, 0.0])
            s[0] += g
            s[1] += h
        below_g = below_h = 0.0
        levels = sorted(by)
        for level, cut in zip(levels, levels[1:], strict=False):
            below_g += by[level][0]
            below_h += by[level][1]
            above_g, above_h = total_g - below_g, total_h - below_h
            gain = below_g ** 2 / (below_h + 1) + above_g ** 2 / (above_h + 1) - total_g ** 2 / (total_h + 1)
            if gain > best[0] + 1e-9:
                best = (gain, name, cut, below_g / (below_h + 1), above_g / (above_h + 1))
    return best


def boost(cells: list[tuple[dict[str, int], float, float]], rounds: int = 80, rate: float = 0.3) -> Model:
    """Trees for cells (features, positives, negatives) under logistic loss."""
    names = [n for n in FEATURES if len({x[n] for x, _, _ in cells}) > 1] or FEATURES[:1]
    pos, neg = sum(p for _, p, _ in cells), sum(n for _, _, n in cells)
    model = Model(bias=math.log((pos + 1) / (neg + 1)))
    scores = [model.bias] * len(cells)
    for _ in range(rounds):
        steps = []
        for (x, p, n), s in zip(cells, scores, strict=True):
            q = 1 / (1 + math.exp(-s))
            steps.append((x, p - q * (p + n), q * (1 - q) * (p + n)))
        _, f, cut, _, _ = _best_split(steps, names)
        tree = [f, cut]
        for side in ([c for c in steps if c[0][f] < cut], [c for c in steps if c[0][f] >= cut]):
            _, g, at, lo, hi = _best_split(side, names) if side else (0, f, 0, 0.0, 0.0)
            tree.append((g, at, rate * lo, rate * hi))
        model.trees.append(tuple(tree))
        scores = [s + _leaf(model.trees[-1], x) for (x, _, _), s in zip(cells, scores, strict=True)]
    return model


def calibrate(model: Model, held_out: list[tuple], precision: float = 0.99, least: float = 0.9) -> None:
    """Per generator, the lowest score whose own held-out cells are positive at
    ``least`` while all from it on are at ``precision``; without such a score it
    selects nothing."""
    for g in {x["generator"] for x, _, _ in held_out}:
        by_score: dict[float, list[float]] = {}
        for x, p, n in held_out:
            if x["generator"] == g:
                sums = by_score.setdefault(round(model.score(x), 9), [0.0, 0.0])
                sums[0] += p
                sums[1] += n
        good = all_ = 0.0
        for s, (p, n) in sorted(by_score.items(), reverse=True):
            good, all_ = good + p, all_ + p + n
            if good < precision * all_:
                break
            if p >= least * (p + n):
                model.thresholds[g] = s - 1e-6


# Examples -------------------------------------------------------------------

# The words of constructed contexts and values.
_LEADS = ["We wrote: ", "", "Please note the ", "in the log, ", "Das ist ", "1. ", "see also\n", "il faut le ", "el texto: ", "- "]
_WORDS = ["hunter", "correct", "horse", "battery", "staple", "dragon", "summer", "monkey", "shadow", "winter", "ab", "qwerty"]
_KEY_CUES = ["password: ", "password=", "Passwd = ", "pwd = ", "pwd:", "token=", "token: ", "auth_token = ", "secret: ", "client secret ",
             "api key \"", "API_KEY=", "api-key: ", "access key ", "key = ", "key: '", "pass ", "PASSWORD \""]
_CALL_CUES = ["tel: ", "Tel. ", "phone ", "Phone: ", "call ", "fax: ", "mobile: ", "Telefon ", "t\u00e9l. ", "ruf "]
_PLAIN = ["commit ", "order ", "version ", "id: ", "id=", "file ", "build: ", "part no. ", "ticket ", "model ", "sha1=", "ref: ", "section ",
          "https://example.org/a/", "img_", "the number ", "isbn ", "year ", "size=", "", "und ", "page ", "see "]


def examples(spark: SparkSession, n: int = EXAMPLES) -> DataFrame:
    """``n`` constructed texts: text, the value's place (start, end), the kind that
    was set into it and whether it is personal (label)."""
    def pick(options: list, salt: int) -> Column:
        return F.get(F.array(*(o if isinstance(o, Column) else F.lit(o) for o in options)),
                     F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(options))).cast("int"))

    def digits(k: int, salt: int) -> Column:
        return F.substring(F.translate(F.md5(F.concat_ws("d", "id", F.lit(salt))), "abcdef", "193857"), 1, k)

    def word(salt: int) -> Column:
        return pick(_WORDS, salt)

    def mixed(k: Column | int, salt: int, letters: str = "K7mQz2XpRt9LvB4s") -> Column:
        hexes = F.concat(*(F.md5(F.concat_ws("m", "id", F.lit(salt + i))) for i in range(2)))
        return F.substring(F.translate(hexes, "0123456789abcdef", letters), F.lit(1), k if isinstance(k, Column) else F.lit(k))

    length = F.lit(12) + F.pmod(F.xxhash64("id", F.lit(99)), F.lit(29)).cast("int")
    sha = F.sha1(F.col("id").cast("string"))
    key = pick([mixed(length, 1), F.concat(word(2), digits(2, 3), word(4), digits(2, 5)), sha, F.substring(sha, F.lit(1), length),
                F.concat(word(6), digits(1, 7), word(8), digits(1, 9), word(10), digits(1, 11), word(12)), F.md5(F.col("id").cast("string")),
                mixed(length, 13, "abc123def456ghi7"), mixed(length, 14, "ZX9KQ2LM5PN8ABCD"),
                F.concat_ws("-", word(15), digits(4, 16), word(17), word(18))], 20)
    key = F.when(F.length(key) < 12, F.concat(key, F.lit("x9"), key)).otherwise(key)
    account = F.concat(pick(["AKIA", "ASIA", "AGPA"], 21), mixed(16, 22, "ZX9KQ2LM5PN8ABCD"))
    number = pick([F.concat(F.lit("0"), digits(2, 23), F.lit(" "), digits(7, 24)), F.concat_ws("-", digits(3, 25), digits(3, 26), digits(4, 27)),
                   F.concat(F.lit("0"), digits(3, 28), F.lit(" "), digits(8, 29)), digits(10, 30),
                   F.concat_ws(" ", F.concat(F.lit("0"), digits(1, 31)), digits(2, 32), digits(2, 33), digits(2, 34), digits(2, 35))], 36)
    local = F.concat(F.lit("("), digits(3, 37), F.lit(") "), digits(3, 38), F.lit("-"), digits(4, 39))
    other = pick([F.concat_ws("-", F.lit("2024"), digits(2, 40), digits(2, 41)), F.concat_ws("-", F.lit("978-3"), digits(2, 42), digits(6, 43), digits(1, 44)),
                  F.concat_ws(" ", digits(1, 45), digits(3, 46), digits(3, 47)), F.concat_ws(".", digits(2, 48), digits(2, 49), digits(4, 50)),
                  F.concat(digits(4, 51), F.lit(" - "), digits(4, 52))], 53)
    dialled = F.concat(F.lit("+"), digits(2, 54), F.lit(" "), digits(3, 55), F.lit(" "), digits(3, 56), F.lit(" "), digits(4, 57))
    short = F.concat(F.lit("+"), digits(1, 58), F.lit(" "), digits(2, 59), F.lit("."), digits(2, 60))
    card = F.concat_ws(" ", *(digits(4, 61 + i) for i in range(4)))
    host = F.concat(word(66), pick([".com", ".org", ".co.uk", "-mail.de"], 67))
    mail = F.concat(word(68), pick([".", "_", "", "\u00e9"], 69), word(70), pick([" (at) ", "(at)", " [at] ", "[AT]", " @ "], 71), host)
    handle = F.concat(word(72), pick([" @ ", "(at)", "@", " @"], 73), pick(["noon", "home", "work", "5"], 74))
    # kind, context, value, label
    made = [("secret", _KEY_CUES, key, True), ("secret", _PLAIN, key, False), ("secret", _PLAIN + _KEY_CUES, account, True),
            ("phone", _CALL_CUES, number, True), ("phone", _PLAIN, number, False), ("phone", _PLAIN + _CALL_CUES, local, True),
            ("phone", _PLAIN + _CALL_CUES, other, False), ("phone", _PLAIN + _CALL_CUES, dialled, True), ("phone", _PLAIN, short, False),
            ("card", _PLAIN, card, luhn(F.regexp_replace(card, " ", ""))), ("email", _PLAIN, mail, True), ("email", _PLAIN, handle, False),
            ("secret", _CALL_CUES, key, False), ("phone", _KEY_CUES, number, False)]
    which = F.pmod(F.xxhash64("id", F.lit(75)), F.lit(len(made))).cast("int")
    rows = F.array(*(F.struct(F.lit(k).alias("kind"), pick(c, 76).alias("before"), v.alias("value"), (F.lit(y) if isinstance(y, bool) else y).alias("label"))
                     for k, c, v, y in made))
    one = spark.range(n).select("id", F.get(rows, which).alias("e"))
    lead = F.concat(pick(_LEADS, 77), F.col("e.before"))
    return one.select(F.concat(lead, F.col("e.value"), pick([".", "", "\" now", ", then", "\n", "'"], 78)).alias("text"), F.length(lead).cast("long").alias("start"),
                      (F.length(lead) + F.length("e.value")).cast("long").alias("end"), F.col("e.kind").alias("kind"), F.col("e.label").alias("label"))


def example_cells(spark: SparkSession, n: int = EXAMPLES, vectors: int = VECTORS) -> dict[bool, list[tuple]]:
    """Feature vectors of the examples' candidates with positives and negatives, by
    whether they are held out. A candidate is positive if it covers a personal
    value of its kind, at most two characters at either end aside."""
    c = F.col("c")
    named = F.get(F.array(*(F.lit(k) for k in KINDS)), c["kind"])
    rows = examples(spark, n).withColumn("c", F.explode(candidates(F.col("text"))))
    covers = (c["start"] <= F.col("start") + 2) & (c["end"] >= F.col("end") - 2) & (named == F.col("kind"))
    labelled = rows.select((F.pmod(F.xxhash64("text"), F.lit(2)) == 1).alias("held_out"),
                           (covers & F.col("label")).cast("int").alias("label"), *(c[f].alias(f) for f in FEATURES))
    sums = labelled.groupBy("held_out", *FEATURES).agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n"))
    got = sums.orderBy(F.desc("n"), "held_out", *FEATURES).limit(vectors).collect()
    return {h: [({k: r[k] for k in FEATURES}, float(r["p"]), float(r["n"] - r["p"])) for r in got if r["held_out"] == h]
            for h in (False, True)}


def train(spark: SparkSession, n: int = EXAMPLES, vectors: int = VECTORS) -> Model:
    """Fit the trees on one half of the examples and calibrate on the other."""
    cells = example_cells(spark, n, vectors)
    model = boost(sorted(cells[False], key=lambda cell: tuple(cell[0].values())))
    calibrate(model, cells[True])
    return model


def quality_by_generator(model: Model, cells: list[tuple]) -> dict[str, tuple[float, float]]:
    """Precision and recall of the selected candidates, by generator."""
    out = {}
    for number, (name, *_) in enumerate(GENERATORS):
        mine = [cell for cell in cells if cell[0]["generator"] == number]
        chosen = [cell for cell in mine if model.score(cell[0]) >= model.thresholds.get(number, math.inf)]
        hit, every = sum(p for _, p, _ in chosen), sum(p + n for _, p, n in chosen)
        out[name] = hit / every if every else 1.0, hit / max(1.0, sum(p for _, p, _ in mine))
    return out


# Results ------------------------------------------------------------------


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _all_spans(model: Model) -> Column:
    """Base spans, and the candidates beside them that the model selects."""
    if not model.thresholds:
        return F.col("base")
    added = _bound(_tops(F.col("base")), lambda tops: F.filter(
        "candidates", lambda c: model.selects(c) & ~_overlaps_any(c, F.col("base"), tops)))
    every = F.array_sort(F.concat("base", F.transform(
        added, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))))
    once = _bound(every, lambda a: F.filter(a, lambda s, i: (i == 0) | (s != F.get(a, i - 1))))  # two generators may propose the same
    return F.when(F.size("candidates") > 0, once).otherwise(F.col("base"))


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, text, base and all spans (arrays of (start, kind, end)) of every
    document. Without a model one is trained on the constructed examples.

    A null text is an empty one; a null doc_id stays; repeated rows are judged
    each; other columns are not read; an empty table gives no rows.
    """
    rows = described(docs)
    model = train(docs.sparkSession) if model is None else model
    spans = _all_spans(model)
    return rows.select("doc_id", "text", "base", spans.alias("spans"))


def report(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans listed."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return find(docs, model).select(
        "doc_id", *(count(k) for k in BASE), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _redacted(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones joined, written as ``[KIND]``."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def written(c: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            begin = F.coalesce(F.get(c["tops"], i - 1), F.lit(0).cast("long"))  # behind all spans before this one
            return F.when(s["start"] >= begin, F.concat(_part(c["blocks"], begin, s["start"]), F.get(names, s["kind"]))).otherwise("")
        rest = _part(c["blocks"], F.element_at(c["tops"], -1), F.length(text).cast("long"))
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    return F.when(F.size(spans) > 0, _bound(F.struct(_tops(spans).alias("tops"), _blocks(text).alias("blocks")), written)).otherwise(text)


def redacted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` with spans in ``text`` replaced; all other columns
    as they are, a null text too."""
    model = train(docs.sparkSession) if model is None else model
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    rows = _described(whole, "row", "text").select("row", "text", _all_spans(model).alias("spans"))
    out = rows.select("row", F.when(F.col("text").isNotNull(), _bound(F.col("spans"), lambda s: _redacted(F.col("text"), s))).alias("clean"))
    return out.select(*((F.col("clean") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
