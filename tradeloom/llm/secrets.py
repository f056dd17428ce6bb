"""Secret scans: fixed patterns, and character Markov models of random strings
and ordinary identifiers compared by log-likelihood ratio (DataFrame functions
only).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.common import LAST_ID, col, id_key, replaced, text_of

#: The base patterns, and how long a match (or its value) must be.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "random")

#: Characters the models know; candidates for the models are made of them.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WORD = r"[A-Za-z0-9+/_=-]{4,}"
SPAN = "struct<start:int,end:int,part:string>"
#: Within a candidate, words stand between runs of these; a stretch of words ends
#: where its ratio above the least average has fallen by ``DROP`` nats.
PIECE = r"[^/=_-]+|[/=_-]+"
LEAST, DROP = 20, 5.0


def matches_of(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def located(text: Column, pattern: str, matches: Column, parts: Column) -> Column:
    """``start, end`` of each match in code points, with its ``part``.

    Cutting the text at the matches gives what stands between them; the lengths
    of both give the positions.
    """
    none = F.lit(None).cast(f"array<{SPAN}>")
    zipped = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), 1, F.size(matches)).alias("gap"),
        matches.alias("match"),
        parts.alias("part"),
    )

    def step(done: Column, item: Column) -> Column:
        start = done["at"] + F.length(item["gap"])
        end = start + F.length(item["match"])
        span = F.struct(start.alias("start"), end.alias("end"), item["part"].alias("part"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("spans"))
    walked = F.aggregate(zipped, begin, step, lambda done: done["spans"])
    return F.coalesce(F.when(F.size(matches) > 0, walked).otherwise(none), begin["spans"])


def with_base_spans(docs: DataFrame, text: str) -> DataFrame:
    """Add the spans of the base kinds, an array column for each.

    A run of the access or hex kind that is too short holds no longer one, so
    the least length is part of the pattern. A too short value of an assignment
    still uses up its text, so it is dropped afterwards.
    """
    t = F.col(text)
    matched = docs.withColumns(
        {
            "__ma": matches_of(t, ASSIGN),
            "__mk": matches_of(t, ACCESS),
            "__mh": matches_of(t, HEX),
        }
    )
    values = F.when(F.size("__ma") > 0, matches_of(t, ASSIGN, 2))
    assign = located(t, ASSIGN, F.col("__ma"), values)
    return matched.withColumns(
        {
            "__assign": F.filter(assign, lambda span: F.length(span["part"]) >= ASSIGN_LEAST),
            "__access": located(t, ACCESS, F.col("__mk"), F.col("__mk")),
            "__hex": located(t, HEX, F.col("__mh"), F.col("__mh")),
        }
    ).drop("__ma", "__mk", "__mh")


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratios, random over ordinary, of each character of
    ``ALPHABET`` after each other; the first row is for starts."""

    ratios: tuple[float, ...]

    def score(self, token: Column) -> Column:
        """Total ratio of a token made of ``ALPHABET``, in nats."""
        table = F.split(F.lit(",".join(f"{r:.5f}" for r in self.ratios)), ",").cast("array<double>")

        def step(done: Column, character: Column) -> Column:
            place = F.position(character, F.lit(ALPHABET))
            ratio = F.get(table, done["last"] * len(ALPHABET) + place - 1)
            return F.struct(place.alias("last"), (done["sum"] + ratio).alias("sum"))

        begin = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
        return F.aggregate(F.split(token, ""), begin, step, lambda done: done["sum"])

    def stretches(self, token: Column, threshold: float, per_character: float) -> Column:
        """``start, end`` of what looks random in a token: all of it, or else
        the stretches of its words that do, the best of each neighbourhood."""
        pieces = F.transform(
            F.regexp_extract_all(token, F.lit(PIECE), F.lit(0)),
            lambda p: F.struct(
                F.length(p).alias("size"), self.score(p).alias("sum"), F.substring(p, 1, 1).isin(*"/=_-").alias("between")
            ),
        )
        able = lambda size, sum_: (size >= LEAST) & (sum_ >= F.greatest(F.lit(threshold), size * per_character))
        over = lambda size, sum_: sum_ - size * per_character

        def closed(s: Column) -> Column:
            span = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
            return F.when(s["end"] > 0, F.concat(s["found"], span)).otherwise(s["found"])

        def state(at, start, sum_, end, best, peak, found) -> Column:
            names = ("at", "start", "sum", "end", "best", "peak", "found")
            return F.struct(*(v.alias(n) for n, v in zip(names, (at, start, sum_, end, best, peak, found))))

        def step(s: Column, p: Column) -> Column:
            before = over(s["at"] - s["start"], s["sum"])
            whole = before + over(p["size"], p["sum"])
            fresh = (before < 0) | (s["peak"] - before > DROP) | (
                (s["end"] > 0) & able(p["size"], p["sum"]) & (whole <= s["best"])
            )
            at = s["at"] + p["size"]
            begun = state(s["at"], s["at"], F.lit(0.0), F.lit(0), F.lit(0.0), F.lit(0.0), closed(s))

            def grown(s: Column) -> Column:
                sum_ = s["sum"] + p["sum"]
                here = over(at - s["start"], sum_)
                better = able(at - s["start"], sum_) & ((s["end"] == 0) | (here > s["best"]))
                return state(
                    at, s["start"], sum_, F.when(better, at).otherwise(s["end"]), F.when(better, here).otherwise(s["best"]),
                    F.greatest(s["peak"], here), s["found"],
                )

            word = F.get(F.transform(F.array(F.when(fresh, begun).otherwise(s)), grown), F.lit(0))
            passed = state(at, s["start"], s["sum"] + p["sum"], s["end"], s["best"], s["peak"], s["found"])
            return F.when(p["between"], passed).otherwise(word)

        none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
        begin = state(F.lit(0), F.lit(0), F.lit(0.0), F.lit(0), F.lit(0.0), F.lit(0.0), none)
        whole = F.array(F.struct(F.lit(0).alias("start"), F.length(token).alias("end")))
        return F.when(able(F.length(token), self.score(token)), whole).otherwise(
            F.when(F.regexp_like(token, F.lit("[/=_-]")), F.aggregate(pieces, begin, step, closed)).otherwise(none)
        )


def blanked(text: Column, spans: Column) -> Column:
    """The text with blanks for what the spans cover, all places kept."""

    def step(done: Column, span: Column) -> Column:
        at = F.greatest(done["at"], span["end"])
        gap = F.substring(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        blank = F.repeat(F.lit(" "), F.greatest(span["end"] - F.greatest(done["at"], span["start"]), F.lit(0)))
        return F.struct(at.alias("at"), F.concat(done["parts"], F.array(F.concat(gap, blank))).alias("parts"))

    begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    joined = F.aggregate(
        ordered, begin, step,
        lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, joined).otherwise(text)


def train(samples: DataFrame, token: str = "token", is_random: str = "is_random", smoothing: float = 20.0) -> MarkovModel:
    """Fit both models to labelled tokens.

    Counts of character pairs are summed before the shuffle; at most
    ``2 * 68 * 67`` of them reach the driver. Characters outside ``ALPHABET``
    are left out, null tokens and labels too. What follows a character is
    smoothed by how often it occurs at all, worth ``smoothing`` samples; without
    any sample of a label its model is uniform.
    """
    width = len(ALPHABET)
    clean = samples.select(
        F.regexp_replace(col(token).cast("string"), "[^A-Za-z0-9+/_=-]", "").alias("t"),
        col(is_random).cast("boolean").alias("r"),
    ).filter("t <> '' AND r IS NOT NULL")
    place = lambda character: F.position(character, F.lit(ALPHABET))
    chars = clean.select("r", F.split("t", "").alias("c"))
    pair = lambda c, i: F.when(i == 0, F.lit(0)).otherwise(place(F.get("c", i - 1))) * width + place(c) - 1
    pairs = chars.select("r", F.explode(F.transform("c", pair)).alias("pair"))
    counts = {True: [0] * (width + 1) * width, False: [0] * (width + 1) * width}
    for row in pairs.groupBy("r", "pair").count().collect():
        counts[row.r][row.pair] = row["count"]

    def logs(kind: bool) -> list[float]:
        rows = [counts[kind][k * width : (k + 1) * width] for k in range(width + 1)]
        seen = [sum(column) for column in zip(*rows)]
        alone = [(n + 1) / (sum(seen) + width) for n in seen]
        return [
            math.log((n + smoothing * p) / (sum(row) + smoothing)) for row in rows for n, p in zip(row, alone)
        ]

    return MarkovModel(tuple(a - b for a, b in zip(logs(True), logs(False))))


def labelled_samples(docs: DataFrame, id_col: str, text_col: str, sample_docs: int) -> DataFrame:
    """``token, is_random`` from the ``sample_docs`` documents of the smallest
    hashes of ids, null ids last: what the base kinds hold is random (values of
    ``ASSIGN_LEAST`` characters or more), other words are ordinary."""
    key = F.when(col(id_col).isNull(), F.lit(LAST_ID)).otherwise(F.xxhash64(id_key(id_col)))
    ids = docs.select(key.alias("k")).orderBy("k").limit(sample_docs)
    last = ids.agg(F.max("k").alias("last")).first()["last"]
    texts = docs.filter(key <= F.lit(-1 if last is None else last)).select(text_of(text_col).alias("t"))
    t = F.col("t")
    random = F.concat(matches_of(t, ASSIGN, 2), matches_of(t, ACCESS), matches_of(t, HEX))
    ordinary = matches_of(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, ASSIGN, " "), ACCESS, " "), HEX, " "), WORD)
    return texts.select(F.explode(random).alias("token"), F.lit(True).alias("is_random")).union(
        texts.select(F.explode(ordinary), F.lit(False))
    ).filter(F.length("token") >= F.when(F.col("is_random"), ASSIGN_LEAST).otherwise(4))


def with_rank(found: Column, rank: int) -> Column:
    return F.transform(
        found, lambda span: F.struct(span["start"].alias("start"), F.lit(rank).alias("rank"), span["end"].alias("end"))
    )


def scan(
    docs: DataFrame,
    model: MarkovModel | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = 2000,
    threshold: float = 20.0,
    per_character: float = 0.8,
) -> DataFrame:
    """Find secrets in every text.

    Adds ``secrets``, an array of ``kind, start, end`` in code points (end
    exclusive) ordered by start and then kind, to the input's columns; a column
    of that name makes room. Kinds are the base kinds ``assign``, ``access``
    and ``hex``, and ``random``: a string of 20 characters or more, apart from
    the base spans, whose total log-likelihood ratio is at least ``threshold``
    nats and ``per_character`` nats a character. If a whole run of characters
    is not one, stretches of its parts between ``/ = - _`` are judged, each
    part alone among them, so ordinary text about a secret does not hide it.
    A base span cuts a run; what lies outside it is judged.

    Without ``model`` one is trained on at most ``sample_docs`` documents, those
    of the smallest hashes of ids (more only if ids repeat). Null and empty texts have no
    secrets; repeated rows are scanned alike; an empty table gives an empty
    table. No shuffle.
    """
    model = model or train(labelled_samples(docs, id_col, text_col, sample_docs))
    spans = with_base_spans(docs.withColumn("__text", text_of(text_col)), "__text")
    base = F.concat("__assign", "__access", "__hex")
    apart = spans.withColumn("__apart", blanked(F.col("__text"), base))
    scored = apart.withColumn("__candidates", matches_of(F.col("__apart"), CANDIDATE)).withColumn(
        "__odd", F.transform("__candidates", lambda token: model.stretches(token, threshold, per_character))
    )
    placed = located(F.col("__apart"), CANDIDATE, F.col("__candidates"), F.col("__candidates"))
    moved = F.zip_with(
        placed,
        "__odd",
        lambda run, odd: F.transform(
            odd,
            lambda s: F.struct(
                (run["start"] + s["start"]).alias("start"), (run["start"] + s["end"]).alias("end"), F.lit("y").alias("part")
            ),
        ),
    )
    added = F.when(F.exists("__odd", lambda odd: F.size(odd) > 0), F.flatten(moved))
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    by_kind = (F.col("__assign"), F.col("__access"), F.col("__hex"), F.coalesce(added, none))
    ranked = [with_rank(found, rank) for rank, found in enumerate(by_kind)]
    names = F.array(*(F.lit(kind) for kind in KINDS))
    ordered = F.transform(
        F.array_sort(F.concat(*ranked)),
        lambda s: F.struct(F.get(names, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return replaced(scored, secrets=ordered).drop(
        "__text", "__apart", "__candidates", "__odd", "__assign", "__access", "__hex"
    )
