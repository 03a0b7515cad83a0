"""Personal data: labelers vote on spans, expectation-maximisation weighs them, a span classifier decides.

All work on texts is done by Spark's own functions. Only counts of patterns of votes and signs,
at most 2^10 for each kind, come to the driver, where the weights are estimated.

Texts are searched in chunks, so that positions are summed over a few matches at a time. A
chunk ends where no pattern can go on: after a character that none of them holds, or between
a letter and a space, which none holds side by side. What stands before a span is looked up in
the chunk before where its own chunk begins too late, so a sentence gets the same votes wherever
a border falls.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

CHUNK_CHARS = 2_000
#: What all patterns below are made of, beside which a chunk may end.
CHUNK = rf"(?s).{{{CHUNK_CHARS}}}.*?(?:[^A-Za-z0-9._%+@ ()-]|[A-Za-z](?= )|\z)|.+"

#: The base kinds. Repetitions are possessive and begin where their run begins (or where the
#: last match ended), which finds the same spans in linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


@dataclass
class Kind:
    """A kind of personal data: where it may stand and which matches count."""

    name: str
    pattern: str
    guard: str  # what a text must contain
    valid: Callable[[Column], Column] = lambda value: F.lit(True)
    #: The labelers of kinds beyond the base: name -> vote from (value, text before it).
    votes: dict[str, Callable[[Column, Column], Column]] = field(default_factory=dict)


BASE = [
    Kind("email", EMAIL, "@"),
    Kind("ip", IP, "[0-9]", lambda v: v.rlike(IP_PARTS)),
    Kind("card", CARD, "[0-9]", lambda v: F.length(digits(v)).between(12, 19) & F.call_function("luhn_check", digits(v))),
    Kind("phone", PHONE, r"\+", lambda v: F.length(digits(v)).between(9, 15)),
]


def labelers(strict: str, names: str, shape: Callable[[Column], Column]) -> dict[str, Callable[[Column, Column], Column]]:
    """A strict pattern, a gazetteer of words that announce the kind, the signs before it, its make-up."""
    return {
        "pattern": lambda v, before: v.rlike(strict),
        "gazetteer": lambda v, before: before.rlike(rf"(?i)(?<![\p{{L}}])(?:{names})(?![\p{{L}}])"),
        "context": lambda v, before: before.rlike(r"""[:=#][\s"'(]*$"""),
        "shape": lambda v, before: shape(v),
    }


EXTRA = [
    Kind(
        "phone",
        r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
        "[0-9]",
        votes=labelers(
            r"^(?:\([2-9][0-9]{2}\) |[2-9][0-9]{2}[.-])[0-9]{3}[.-][0-9]{4}$",
            "phone|tel|telephone|call|mobile|cell|fax|telefon|anruf|handy|móvil|teléfono|téléphone|portable",
            lambda v: v.rlike(r"^(?:\([0-9]{3}\) [0-9]{3}-|[0-9]{3}([.-])[0-9]{3}\1)"),
        ),
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "[0-9]",
        votes=labelers(
            r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
            "ssn|social security|social",
            lambda v: ~v.rlike(r"^([0-9])\1\1-\1\1-\1{4}$"),
        ),
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{20,}+",
        "[0-9]",
        lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]"),
        labelers(
            r"^(?:(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})|(?:[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_[A-Za-z0-9_]{20,})$",
            "token|secret|key|api|password|passwd|pwd|bearer|credential|auth",
            lambda v: F.regexp_count(v, F.lit("[0-9][A-Za-z]|[A-Za-z][0-9]")) >= 4,
        ),
    ),
]
#: Order of kinds among spans that begin at one place.
NAMES = ["email", "ip", "card", "phone", "ssn", "secret"]
#: What the classifier sees of a span beside the votes: its length, its characters, what stands before it.
SIGNS: dict[str, Callable[[Column, Column], Column]] = {
    "long": lambda v, before: F.length(v) >= 24,
    "mostly digits": lambda v, before: 2 * F.length(digits(v)) >= F.length(v),
    "both cases": lambda v, before: v.rlike("[A-Z]") & v.rlike("[a-z]"),
    "few characters": lambda v, before: 2 * F.size(F.array_distinct(F.split(v, ""))) < F.length(v),
    "after a word": lambda v, before: before.rlike(r"\p{L}{2} \z"),
    "after a quote": lambda v, before: before.rlike(r"""["'(\[<]\z"""),
}
#: A span beyond the base counts if the classifier is so sure of it.
SURE = 0.9
#: Weight of the two cases that are known, all votes and none, as a part of the candidates.
SEEDS = 0.1
BEFORE = 32

SPAN = "array<struct<s:bigint,k:int,e:bigint,base:boolean>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Numbers that are summed one by one; longer runs go by their sums.
RUN = 32


def sums_before(steps: Column) -> Column:
    """For each number of a non-empty array the sum of those before it, in time about proportional to its length.

    An array that grows by a number at a time is copied each time, so runs of ``RUN``
    are summed first and only their sums grow such an array.
    """
    zero, plus = F.lit(0).cast("bigint"), lambda a, x: a + x

    def of(runs: Column) -> Column:
        start = F.struct(zero.alias("at"), F.expr("cast(array() as array<bigint>)").alias("out"))
        each = F.transform(runs, lambda run: F.aggregate(run, zero, plus))
        begins = F.aggregate(
            each, start, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"]
        )
        inside = lambda run, begin: F.transform(run, lambda _, i: begin + F.aggregate(F.slice(run, F.lit(1), i), zero, plus))
        return let(begins, lambda begins: F.flatten(F.transform(runs, lambda run, j: inside(run, F.get(begins, j)))))

    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN).cast("int")), lambda j: F.slice(steps, j * RUN + 1, F.lit(RUN)))
    return let(runs, of)


def matches(chunk: Column, kind: Kind, lead: Column) -> Column:
    """Matches of a kind: array of (s, e, value, before); positions are code points of the chunk.

    ``before`` is what the text has since the last match of the kind, at most ``BEFORE``
    characters of it; ``lead``, the chunk before, gives what ``chunk`` lacks of it and no spans.
    """
    none = F.expr("cast(array() as array<struct<s:bigint,e:bigint,value:string,before:string>>)")

    since = F.element_at(F.split(lead, kind.pattern, -1), -1)

    def before(gap: Column, i: Column) -> Column:
        first = (i == 0) & (F.length(gap) < BEFORE)
        return F.right(F.when(first, F.concat(since, gap)).otherwise(gap), F.lit(BEFORE))

    def placed(values: Column, gaps: Column) -> Column:
        def at(begins: Column) -> Column:
            def one(value: Column, i: Column) -> Column:
                gap = F.get(gaps, i)
                return let(
                    F.get(begins, i) + F.length(gap),
                    lambda s: F.struct(s.alias("s"), (s + F.length(value)).alias("e"), value.alias("value"), before(gap, i).alias("before")),
                )

            return F.transform(values, one)

        steps = F.transform(values, lambda v, i: (F.length(F.get(gaps, i)) + F.length(v)).cast("bigint"))
        return let(sums_before(steps), at)

    found = let(
        F.regexp_extract_all(chunk, F.lit(kind.pattern), F.lit(0)),
        lambda values: F.when(F.size(values) > 0, let(F.split(chunk, kind.pattern, -1), lambda gaps: placed(values, gaps))).otherwise(none),
    )
    return F.filter(F.when(chunk.rlike(kind.guard), found).otherwise(none), lambda m: kind.valid(m["value"]))


def chunks_of(text: Column) -> Column:
    """Array of (at, chunk, lead): whole text in order; ``lead`` is the chunk before, empty for the first one."""
    cut = F.when(F.length(text) <= 2 * CHUNK_CHARS, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0)))
    begins = lambda parts: F.aggregate(
        parts,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<bigint>)").alias("out")),
        lambda acc, c: F.struct((acc["at"] + F.length(c)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"],
    )
    lead = lambda parts, i: F.coalesce(F.get(parts, i - 1), F.lit("")).alias("lead")
    return let(cut, lambda parts: F.transform(begins(parts), lambda at, i: F.struct(at.alias("at"), F.get(parts, i).alias("chunk"), lead(parts, i))))


def may_hold(text: Column) -> Column:
    return text.rlike("[0-9@]")


def seen(kind: Kind, value: Column, before: Column) -> list[Column]:
    """The votes of a kind's labelers, then the signs, each 0 or 1."""
    return [test(value, before).cast("int") for test in (*kind.votes.values(), *SIGNS.values())]


@dataclass
class SpanModel:
    """For each kind beyond the base the weights of votes and signs; a span counts if their sum is above 0."""

    weights: dict[str, tuple[float, ...]]  # kind -> bias, then one weight for each labeler and each sign

    def accepts(self, kind: Kind, value: Column, before: Column) -> Column:
        bias, *weights = self.weights[kind.name]
        return sum((x * F.lit(float(w)) for x, w in zip(seen(kind, value, before), weights)), F.lit(float(bias))) > 0


def spans_in(chunk: Column, lead: Column, model: SpanModel) -> Column:
    """All spans of a chunk in order: base ones, and accepted ones that overlap none of these; see ``matches`` for ``lead``."""
    shaped = lambda kind, base: lambda m: F.struct(
        m["s"].alias("s"), F.lit(NAMES.index(kind.name)).alias("k"), m["e"].alias("e"), F.lit(base).alias("base")
    )
    base = F.concat(*[F.transform(matches(chunk, kind, lead), shaped(kind, True)) for kind in BASE])
    # a lambda's second parameter would be the index, so the kind is bound by a call
    accepted = lambda kind: F.filter(matches(chunk, kind, lead), lambda m: model.accepts(kind, m["value"], m["before"]))
    more = [F.transform(accepted(kind), shaped(kind, False)) for kind in EXTRA if kind.name in model.weights]
    if not more:
        return F.array_sort(base)
    clear = lambda known: F.filter(F.concat(*more), lambda m: ~F.exists(known, lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"])))
    return let(base, lambda known: F.array_sort(F.concat(known, clear(known))))


def em(votes: np.ndarray, n: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of each vote pattern, occurring ``n`` times, to be a true span.

    Two classes, labelers independent within each: reliabilities and posteriors are estimated
    in turn, from the majority on. Two cases are known and count with the candidates: what all
    labelers vote for is a true span, what none does isn't. They tie the classes to their
    meaning where all candidates look alike. A little is added to all counts, so that no
    reliability is 0 or 1.
    """
    p = (votes.sum(axis=1) + 0.5) / (votes.shape[1] + 1)
    seeds = SEEDS * n.sum()
    for _ in range(rounds):
        true, false = (n * p).sum() + seeds, (n * (1 - p)).sum() + seeds
        yes = ((n * p) @ votes + seeds + 1) / (true + 2)
        wrong = ((n * (1 - p)) @ votes + 1) / (false + 2)
        odds = np.log(true / false) + votes @ np.log(yes / wrong) + (1 - votes) @ np.log((1 - yes) / (1 - wrong))
        p = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return p


def span_classifier(x: np.ndarray, n: np.ndarray, p: np.ndarray, rounds: int = 500) -> tuple[float, ...]:
    """Logistic regression on the columns of ``x`` with the posteriors as soft labels: bias, weights."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    share = n / n.sum()
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (share * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (share * (p - q)) - 1e-3 * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Count what is seen of all candidate spans of all texts, and learn from the counts.

    Reliabilities and posteriors come from the votes alone; the classifier then learns the
    posteriors from votes and signs. ``SURE`` is taken off the bias, so sums are compared with 0.
    """
    text = F.col("_text")
    texts = docs.select(text_or_empty(F.col(f"`{text_col}`")).alias("_text")).where(may_hold(text))
    parts = texts.select(F.explode(chunks_of(text)).alias("_c")).select("_c.chunk", "_c.lead").where(F.col("chunk").rlike("[0-9]"))
    n_votes = len(EXTRA[0].votes)
    names = [f"x{i}" for i in range(n_votes + len(SIGNS))]
    row = lambda kind: lambda m: F.struct(
        F.lit(kind.name).alias("kind"), *[x.alias(c) for x, c in zip(seen(kind, m["value"], m["before"]), names)]
    )
    cast = F.concat(*[F.transform(matches(F.col("chunk"), kind, F.col("lead")), row(kind)) for kind in EXTRA])
    counts = parts.select(F.explode(cast).alias("_v")).select("_v.*").groupBy("kind", *names).agg(F.count(F.lit(1)).alias("n")).orderBy("kind", *names).collect()
    weights = {}
    for kind in EXTRA:
        rows = [r for r in counts if r["kind"] == kind.name]
        if rows:
            x = np.array([[r[c] for c in names] for r in rows], dtype=float)
            n = np.array([r["n"] for r in rows], dtype=float)
            votes, of = np.unique(x[:, :n_votes], axis=0, return_inverse=True)
            posterior = em(votes, np.bincount(of.ravel(), weights=n))
            bias, *rest = span_classifier(x, n, posterior[of.ravel()])
            weights[kind.name] = (bias - float(np.log(SURE / (1 - SURE))), *rest)
    return SpanModel(weights)


def find_spans(docs: DataFrame, model: SpanModel, text_col: str = "text", result: str = "spans") -> DataFrame:
    """Add ``spans``: array of (s, k, e, base), sorted; s and e in code points, e exclusive.

    ``k`` is the place of the kind in ``NAMES``; ``base`` tells the spans of the fixed rules from
    those that the classifier added. A null text has none, like the empty one; every row is
    searched by itself, so repeated rows get equal spans; a column named like the result is replaced.
    """
    text = text_or_empty(F.col(f"`{text_col}`"))
    moved = lambda c: F.transform(spans_in(c["chunk"], c["lead"], model), lambda m: F.struct((m["s"] + c["at"]).alias("s"), m["k"].alias("k"), (m["e"] + c["at"]).alias("e"), m["base"].alias("base")))
    found = F.flatten(F.transform(chunks_of(text), moved))
    return docs.withColumn(result, F.when(may_hold(text), found).otherwise(F.expr(f"cast(array() as {SPAN})")))


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.get(names, m["k"]), m["s"], m["e"])), ",")


def mask(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """Replace every span in ``text_col`` by its kind in capitals, <EMAIL> for one; overlapping spans become one mark.

    Null texts and texts without spans stay as they are, as do all other columns.
    """
    text = F.col(f"`{text_col}`")
    marks = F.array(*[F.lit(f"<{n.upper()}>") for n in NAMES])

    def masked(c: Column, lead: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

        def add(acc: Column, m: Column) -> Column:
            between = F.substring(c, (acc["at"] + 1).cast("int"), (m["s"] - acc["at"]).cast("int"))
            apart = F.concat(acc["out"], between, F.get(marks, m["k"]))
            return F.struct(F.greatest(acc["at"], m["e"]).alias("at"), F.when(m["s"] >= acc["at"], apart).otherwise(acc["out"]).alias("out"))

        rest = lambda acc: F.concat(acc["out"], F.substring(c, (acc["at"] + 1).cast("int"), F.length(c)))
        return let(spans_in(c, lead, model), lambda spans: F.when(F.size(spans) == 0, c).otherwise(F.aggregate(spans, start, add, rest)))

    changed = F.array_join(F.transform(chunks_of(text.cast("string")), lambda c: masked(c["chunk"], c["lead"])), "")
    return docs.withColumn(text_col, F.when(may_hold(text), changed).otherwise(text))
