"""Personal data: exact base patterns, and bootstrapped contexts that find more.

Base spans come from four regular expressions. Tokens with a digit or ``@`` are candidate
instances. A token's lexical patterns are the two words before it, the one before it, the
one after it, and both neighbours. Seeds are tokens that hold a base span, and long
hexadecimal values after ``=`` or ``:`` (kind ``secret``). The graph of patterns and
instances is scored in rounds: a pattern's confidence is the mean score of its distinct
instances, an instance's score the noisy-or of its trusted patterns. Patterns with enough
seeds and a high confidence mark the other tokens they stand beside as identifiers of the
pattern's kind.

Everything is built-in functions and joins. One pass reads the texts and keeps only the
matches with their distances and neighbours; positions are running sums of those per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlens.staging import stage

KINDS = ("email", "ip", "card", "phone")
# Starts are anchored where a run begins or the last match ended, and runs are possessive:
# the same matches as the plain patterns, in time linear in the text.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    # Runs are maximal, so runs with too few digits need not be listed.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Blank-separated runs that hold a digit or ``@``.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
OCTET = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: What stands around a token and is not part of it.
OPENING, CLOSING = r"[\"'(\[<{]", r"[\"')\]>},.;:!?#$%&*]"
#: Values that are seeds of the kind ``secret`` after a word that ends so.
SECRET, ASSIGNED = r"^(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,}+\z", r"[=:]\z"
CONTEXTS = tuple(f"context_{k}" for k in (*KINDS, "secret"))
#: Stand for a missing word: the text's end, or another token.
EDGE, OTHER = "^", "#"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    size = F.length(digits)
    return (
        F.when(kind == "ip", match.rlike(rf"^{OCTET}(\.{OCTET}){{3}}\z"))
        .when(kind == "card", size.between(12, 19) & F.call_function("luhn_check", digits))
        .when(kind == "phone", size.between(9, 15))
        .otherwise(kind == "email")
    )


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


_MATCH = "struct<kind: string, place: bigint, gap: bigint, match: string, words: array<string>>"


def _matches(text: Column, kind: str, pattern: str, may_match: Column) -> Column:
    """array<(kind, place, gap, match, words)>: matches with the length of the text since the one before.

    For tokens ``words`` are the first and the last two words of that text, and the text after
    the last token has a row without a match.
    """
    # Each array is computed once for the text and walked along with the other.
    parts = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1), lambda m, g: F.struct(m.alias("m"), g.alias("g"))
    )

    def row(part: Column, place: Column) -> Column:
        words = _words(part["g"])
        ends = F.concat(F.slice(words, 1, 1), F.slice(F.concat(F.array(F.lit(""), F.lit("")), words), -2, 2))
        return F.struct(
            F.lit(kind).alias("kind"),
            place.cast("long").alias("place"),
            F.length(part["g"]).cast("long").alias("gap"),
            part["m"].alias("match"),
            (ends if kind == "token" else F.expr("cast(null as array<string>)")).alias("words"),
        )

    if kind != "token":
        parts = F.filter(parts, lambda p: p["m"].isNotNull())
    return F.when(may_match, F.transform(parts, row)).otherwise(F.expr(f"cast(array() as array<{_MATCH}>)"))


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in (*KINDS, *CONTEXTS)]), kind)


def score_patterns(edges: DataFrame, rounds: int, least_seeds: int, confidence: float) -> DataFrame:
    """(pattern, kind, confidence) of trusted patterns from (pattern, instance, kind, seed).

    ``edges`` has one row per distinct pattern and instance; kind is that of a seed, else null.
    """
    scores = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    trusted = None
    for _ in range(rounds):
        # An instance's own pattern must not vouch for it alone: unseen ones enter with what other patterns say.
        rated = (
            edges.join(scores, "instance")
            .groupBy("pattern")
            .agg(
                # Rounded, so that the order of summing decides nothing.
                F.round(F.avg("score"), 9).alias("confidence"),
                F.count(F.when(F.col("seed"), 1)).alias("seeds"),
                F.mode("kind", deterministic=True).alias("kind"),
            )
        )
        trusted = stage(
            rated.where((F.col("seeds") >= least_seeds) & (F.col("confidence") >= confidence)).select(
                "pattern", "kind", "confidence"
            ),
            "private-patterns",
        )
        said = (
            edges.join(trusted.select("pattern", "confidence"), "pattern")
            .groupBy("instance")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))).alias("said"))
        )
        seeds = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("seed"))
        scores = stage(
            seeds.join(said, "instance", "left").select(
                "instance", F.greatest("seed", F.coalesce("said", F.lit(0.0))).alias("score")
            ),
            "private-scores",
        )
    return trusted


def personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    least_seeds: int = 3,
    confidence: float = 0.6,
) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, spans) for every row of ``docs``.

    ``base`` and ``spans`` list ``kind:start:end`` (code points, end exclusive) by start and
    kind; ``spans`` adds the tokens found by context as ``context_<kind>``, which count in no
    n column and never overlap a base span: tokens beside a pattern with ``least_seeds``
    distinct seeds and a mean score of ``confidence``, without the quotes and stops around
    them. Of several patterns the most confident names the kind, of a pattern's seeds the most
    frequent kind counts, the first by name where they tie; a seed's kind is that of the base
    span that touches it and reaches furthest. A context word is as long as it
    is; where a word is missing, the text's end and another token are told apart. Null and empty texts hold nothing. Rows with the
    same id and text get the same result; the order of rows plays no part. An empty table
    gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    t = F.col("text")
    digit = t.rlike("[0-9]")
    may = {"email": F.contains(t, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(t, F.lit("+"))}
    lists = [_matches(t, kind, PATTERNS[kind], may[kind]) for kind in KINDS]
    lists.append(_matches(t, "token", TOKEN, t.rlike("[0-9@]")))
    read = stage(rows.select("id", F.xxhash64("text").alias("same"), F.concat(*lists).alias("found")), "private-matches")

    # Positions: running sums within a text and kind.
    texts = read.where(F.size("found") > 0).dropDuplicates(["id", "same"])
    listed = texts.select("id", "same", F.explode("found").alias("m")).select("id", "same", "m.*")
    running = Window.partitionBy("id", "same", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_order = Window.partitionBy("id", "same", "kind").orderBy("place")
    end = F.sum(F.col("gap") + F.coalesce(F.length("match"), F.lit(0))).over(running)
    placed = listed.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    placed = placed.withColumn("following", F.lead("words").over(in_order)).where("match is not null")
    placed = stage(placed.where((F.col("kind") == "token") | _valid(F.col("kind"), F.col("match"))), "private-spans")

    span = F.struct(F.col("start"), _order(F.col("kind")).alias("order"), F.col("kind"), F.col("end"))
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS]
    base = stage(
        placed.where("kind <> 'token'").groupBy("id", "same").agg(*counts, F.collect_list(span).alias("base")), "private-base"
    )

    # Tokens with their neighbours; quotes and stops around a token are not part of it.
    lead = F.length(F.regexp_extract("match", rf"^({OPENING}*+)", 1))
    before = F.when(F.col("place") == 0, EDGE).otherwise(OTHER)
    missing = lambda word, none: F.when(word == "", none).otherwise(word)
    # Of a text without words, ``words`` holds the two fillers alone.
    after = F.when(F.size("following") == 3, F.get("following", F.lit(0))).otherwise("")
    token = (
        placed.where("kind = 'token'")
        .withColumn("instance", F.regexp_extract("match", rf"^{OPENING}*+(.*?){CLOSING}*\z", 1))
        .withColumn("start", F.col("start") + lead)
        .withColumn("end", F.col("start") + F.length("instance"))
        .withColumn("second", missing(F.element_at("words", -2), before))
        .withColumn("first", F.element_at("words", -1))
        .withColumn("after", after)
        .where(F.length("instance") > 0)
    )
    # Of the base spans that begin before a token ends, the one that reaches furthest tells whether any touches it.
    reach = F.struct(F.col("end").alias("until"), (-_order(F.col("kind"))).alias("order"), F.col("kind"))
    spans = placed.where("kind <> 'token'").select("id", "same", F.col("start").alias("at"), F.lit(1).alias("turn"), reach.alias("reach"))
    along = Window.partitionBy("id", "same").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    token = token.select("id", "same", F.col("end").alias("at"), F.lit(0).alias("turn"), "instance", "start", "end", "second", "first", "after")
    token = token.unionByName(spans, allowMissingColumns=True).withColumn("reach", F.max("reach").over(along)).where("turn = 0")
    token = token.withColumn("covered", F.coalesce(F.col("reach.until") > F.col("start"), F.lit(False)))
    secret = F.col("instance").rlike(SECRET) & F.col("first").rlike(ASSIGNED)
    named = lambda shown, *words: F.when(shown, F.concat_ws(" ", *words))
    patterns = F.array_compact(
        F.array(
            named(F.col("first") != "", F.col("second"), F.col("first"), F.lit("_")),
            named(F.col("first") != "", F.col("first"), F.lit("_")),
            named(F.col("after") != "", F.lit("_"), F.col("after")),
            named((F.col("first") != "") & (F.col("after") != ""), F.col("first"), F.lit("_"), F.col("after")),
        )
    )
    token = stage(
        token.select(
            "id", "same", "instance", "start", "end", "covered",
            F.when(F.col("covered"), F.col("reach.kind")).when(secret, "secret").alias("kind"), patterns.alias("patterns"),
        ),
        "private-tokens",
    )
    beside = token.withColumn("pattern", F.explode("patterns"))
    edges = stage(
        beside.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.max(F.col("kind").isNotNull()).alias("seed")),
        "private-edges",
    )
    trusted = score_patterns(edges, rounds, least_seeds, confidence)
    # A base span stays as it is; a secret is one by its pattern, as an unseen identifier is.
    discovered = (
        beside.where(~F.col("covered"))
        .join(trusted.withColumnRenamed("kind", "of_kind"), "pattern")
        .groupBy("id", "same", "start", "end")
        .agg(F.max(F.struct("confidence", "of_kind")).alias("best"))
        .select("id", "same", "start", "end", F.concat(F.lit("context_"), "best.of_kind").alias("kind"))
    )
    added = discovered.groupBy("id", "same").agg(F.collect_list(span).alias("added"))

    empty = F.expr("cast(array() as array<struct<start: bigint, order: bigint, kind: string, end: bigint>>)")
    both = base.withColumn("added", empty).unionByName(
        added.select("id", "same", *[F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS], empty.alias("base"), "added")
    )
    both = both.groupBy("id", "same").agg(
        *[F.sum(f"n_{k}").alias(f"n_{k}") for k in KINDS],
        F.flatten(F.collect_list("base")).alias("base"),
        F.flatten(F.collect_list("added")).alias("added"),
    )
    both = both.withColumnsRenamed({"id": "of", "same": "of_same"})
    joined = read.select("id", "same").join(both, F.col("id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("of_same")), "left")
    base_list, added_list = F.coalesce("base", empty), F.coalesce("added", empty)
    return joined.select(
        "id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        _joined(base_list).alias("base"),
        _joined(F.concat(base_list, added_list)).alias("spans"),
    )
