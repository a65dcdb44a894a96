"""Secret scan: three fixed patterns, and character Markov models for other random strings.

Only built-in column functions are used.  The places of all matches of a pattern follow from two
built-ins: ``split`` gives the texts between matches and ``regexp_extract_all`` the matches, so the
running sum of their lengths gives every start and end.

Besides the fixed patterns, any long run of token characters is a candidate.  Two first-order Markov
models over characters, of random strings and of ordinary identifiers, compare their log-likelihoods
per character.  They are trained from samples that the corpus labels itself: values that the fixed
patterns caught are random strings, long runs of letters and underscores are identifiers.  Every
such string of every document counts; the pair counts are summed in the tasks first, and the models
have at most (characters of the candidate class + 1)^2 entries, so they fit in the plan.

Places are in code points, ends exclusive.  Defined cases: null texts are empty ones and have no
spans; repeated rows and null ids give their own rows; without samples of both kinds the models add
nothing; an empty table gives an empty result; other columns are ignored or, in redaction, kept.
"""

from __future__ import annotations

import json
import math
import string
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: the patterns of the base kinds, in the order in which they are listed --------
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # runs are matched whole, so this is the run of 16 or more
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8
# --------------------------------------------------------------------------------------------------
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z_]{12,}"
MARKOV = "markov"
KINDS = ["assign", "access", "hex", MARKOV]
CHARACTERS = string.ascii_letters + string.digits + "+/_.=-"
ALPHABET = len(CHARACTERS)
BACKOFF = 20.0  # weight of the single characters against the pairs seen
THRESHOLD = 0.7  # log-likelihood ratio per character from which a candidate is a secret
BEGIN = "^"
PLACE = "match string, start int, stop int"


def places(text: Column, pattern: str) -> Column:
    """array<struct(match, start, stop)> of the leftmost matches that do not overlap."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast(f"array<struct<{PLACE}>>")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        stop = start + F.length(pair["match"])
        found = F.struct(pair["match"].alias("match"), start.alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.array_append(state["found"], found).alias("found"))

    pairs = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)), lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    found = F.aggregate(pairs, start, add, lambda state: state["found"])
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(empty)


def with_base(docs: DataFrame) -> DataFrame:
    """Adds text_ (never null) and the array columns assign, access and hex."""
    whole = docs.withColumn("text_", F.coalesce(F.col("text"), F.lit("")))
    value = lambda m: F.regexp_extract(m["match"], ASSIGN, 2)
    found = whole.withColumns({"assign": places(F.col("text_"), ASSIGN), "access": places(F.col("text_"), ACCESS), "hex": places(F.col("text_"), HEX)})
    return found.withColumn("assign", F.filter("assign", lambda m: F.length(value(m)) >= ASSIGN_LEAST))


def base_spans() -> Column:
    """array<struct(start, kind number, stop)> of the base kinds."""
    return F.concat(*(spans_of(kind, number) for number, kind in enumerate(KINDS[:3])))


def spans_of(found: str | Column, number: int) -> Column:
    """The places as spans of the kind with this number."""
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["stop"].alias("stop")))


def with_candidates(found: DataFrame) -> DataFrame:
    """Adds base (spans) and candidates (match, start, stop) that touch no base span."""
    apart = lambda c: ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"]))
    return found.withColumn("base", base_spans()).withColumn("candidates", F.filter(places(F.col("text_"), CANDIDATE), apart))


def samples(found: DataFrame) -> DataFrame:
    """(value, random): the strings the corpus labels itself."""
    value = lambda m: F.regexp_extract(m["match"], ASSIGN, 2)
    match = lambda m: m["match"]
    caught = F.concat(F.transform("assign", value), F.transform("access", match), F.transform("hex", match))
    ordinary = F.regexp_extract_all("text_", F.lit(IDENTIFIER), F.lit(0))
    label = lambda strings, random: F.transform(strings, lambda s: F.struct(s.alias("value"), F.lit(random).alias("random")))
    return found.select(F.inline(F.concat(label(caught, True), label(ordinary, False)))).where(F.regexp_like("value", F.lit("^[A-Za-z0-9+/_.=-]+$")))


def pairs_of(value: Column) -> Column:
    """Each character with the one before it."""
    padded = F.concat(F.lit(BEGIN), value)
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substring(padded, i, 2))


def log_ratios(found: DataFrame) -> dict[str, float] | None:
    """pair -> log of the two smoothed probabilities; None without samples of both kinds."""
    pairs = samples(found).select("random", F.explode(pairs_of(F.col("value"))).alias("pair"))
    counts = pairs.groupBy("pair").agg(F.count(F.when(F.col("random"), 1)).alias("r"), F.count(F.when(~F.col("random"), 1)).alias("o")).collect()
    if not any(c["r"] for c in counts) or not any(c["o"] for c in counts):
        return None
    before, after = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for c in counts:
        for total, char in ((before, c["pair"][0]), (after, c["pair"][1])):
            total[char][0] += c["r"]
            total[char][1] += c["o"]
    size = [sum(x[k] for x in after.values()) for k in (0, 1)]

    def single(char: str, k: int) -> float:
        """Chance of a character; random strings may come from alphabets that no sample shows."""
        seen = (after[char][k] + 0.5) / (size[k] + 0.5 * ALPHABET)
        return seen if k else (seen + 1 / ALPHABET) / 2

    def chance(c, k: int) -> float:
        first, second = c["pair"]
        return (c["ro"[k]] + BACKOFF * single(second, k)) / (before[first][k] + BACKOFF)

    ratios = {c["pair"]: math.log(chance(c, 0) / chance(c, 1)) for c in counts}
    # A pair that no sample holds counts as its second character alone.
    return ratios | {char: math.log(single(char, 0) / single(char, 1)) for char in CHARACTERS}


def score(value: Column, ratios: dict[str, float]) -> Column:
    """Mean log-likelihood ratio per character."""
    table = F.from_json(F.lit(json.dumps(ratios)), "map<string,double>")
    ratio = lambda p: F.coalesce(F.try_element_at(table, p), F.try_element_at(table, F.substring(p, 2, 1)), F.lit(0.0))
    total = F.aggregate(pairs_of(value), F.lit(0.0), lambda s, p: s + ratio(p))
    return total / F.length(value)


def with_spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds text_, base and spans (sorted arrays of start, kind number, stop) to every row."""
    found = with_candidates(with_base(docs))
    ratios = log_ratios(found)
    added = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    if ratios is not None:
        secret = F.filter("candidates", lambda c: score(c["match"], ratios) >= threshold)
        added = spans_of(secret, 3)
    return found.withColumns({"base": F.array_sort("base"), "spans": F.array_sort(F.concat("base", added))})


def listed(spans: str) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["stop"])), ",")


def secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row."""
    return with_spans(docs, threshold).select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", threshold: float = THRESHOLD) -> DataFrame:
    """Every row, with ``mark`` in place of each stretch that spans cover; n_chars follows the text."""
    rows = with_spans(docs.select("text", F.struct(*docs.columns).alias("row_")), threshold)

    def merge(state: Column, span: Column) -> Column:
        last = F.element_at(state, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        more = F.array_append(state, F.struct(span["start"].alias("start"), span["stop"].alias("stop")))
        meets = (F.size(state) > 0) & F.coalesce(span["start"] < F.try_element_at(state, F.lit(-1))["stop"], F.lit(False))
        return F.when(meets, F.array_append(F.slice(state, F.lit(1), F.size(state) - 1), joined)).otherwise(more)

    def cut(state: Column, span: Column) -> Column:
        piece = F.substring(F.col("text_"), state["at"] + 1, span["start"] - state["at"])
        return F.struct(span["stop"].alias("at"), F.concat(state["out"], piece, F.lit(mark)).alias("out"))

    stretches = F.aggregate("spans", F.array().cast("array<struct<start:int,stop:int>>"), merge)
    done = F.aggregate(stretches, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut)
    end = F.substring(F.col("text_"), done["at"] + 1, F.length("text_"))
    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.concat(done["out"], end))
    size = F.length(F.coalesce(clean, F.lit("")))
    changed = {"text": clean} | ({"n_chars": size.cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return rows.select(*(changed.get(c, F.col("row_")[c]).alias(c) for c in docs.columns))
