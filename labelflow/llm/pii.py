"""Personal data by bootstrapped contextual extraction.

The base patterns (email, ip, card, phone) find the seeds. Seeds and candidates (texts of a
kind's shape that the base patterns do not cover) are instances; the words around them are
lexical patterns. Spark scores the pattern-instance graph in rounds until nothing changes: a pattern's confidence
for a kind is the summed score of that kind's instances among all identifier-like instances
seen in it, and a candidate's score is the best confidence of its accepted patterns. Patterns
need ``min_support`` different instances that are seeds or accepted, and ``min_confidence``.
Occurrences of candidates inside accepted patterns are added to the base spans.

What a base pattern matched and its check refused (a card of 16 digits or more that fails Luhn, an
address part over 255) is never added, nor is anything that overlaps a base match. Each match
decides this for its own place only. Shorter digit runs are no cards to the base patterns: three
groups with 12 to 15 digits are candidates for cards.

Only DataFrame functions run. Offsets are code points, ends exclusive. Null text counts as
empty; it and texts without identifiers have no spans. Repeated rows are handled one by one
and count once as instances. An empty table gives an empty result. Other columns are ignored.

The patterns are written so that the regex engine neither backtracks over nor recurses into a
long run; what they match is the plain form's leftmost non-overlapping matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import ROW_ID, id_text, materialise, with_row_id

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this holds no match that passes its kind's check.
NEEDED = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){15}", "phone": r"\+[0-9]"}
#: Shapes of identifiers that the base patterns do not cover; "other" is any further token with a digit.
SHAPES = {
    "email": r"(?<![^\s])[A-Za-z0-9._%+-]++(?:@| ?[\[(]at[\])] ?)[A-Za-z0-9][A-Za-z0-9.-]*+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9]{4,6}[ -][0-9]{4,6}[ -][0-9]{4,6}(?![0-9])",
    "phone": r"(?<![0-9+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "other": r"(?<![^\s])[^\s0-9]*+[0-9][^\s]*+",
}
#: Fewest digits of a card by the base patterns; a candidate has fewer (12 and up, as its shape says).
CARD_DIGITS = 16
_CONTEXT = 60


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start,end,value,left,right>> of a pattern's matches; positions from the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    pieces = F.split(text, pattern, -1)
    zipped = F.arrays_zip(found.alias("value"), pieces.alias("before"), F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))).alias("after"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string,left:string,right:string>>")

    def step(acc, x):
        start = acc["at"] + F.char_length(x["before"])
        end = start + F.char_length(x["value"])
        span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), x["value"].alias("value"),
                        F.right(x["before"], F.lit(_CONTEXT)).alias("left"), F.left(x["after"], F.lit(_CONTEXT)).alias("right"))
        return F.when(x["value"].isNull(), acc).otherwise(
            F.struct(end.cast("int").alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans")))

    return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.char_length(digits)
    if kind == "ip":
        short = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(short, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")))
    if kind == "phone":
        return n.between(8, 15)
    if kind == "card":
        def digit(total, i):
            d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
            twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
            return total + F.when(i % 2 == 0, twice).otherwise(d)

        luhn = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), digit)
        return F.when(n.between(CARD_DIGITS, 19), luhn % 10 == 0).otherwise(False)
    return F.lit(True)


_SPANS = "array<struct<kind:string,start:int,end:int,value:string,left:string,right:string,ok:boolean>>"


def _spans(text: Column, patterns: dict[str, str], needed: dict[str, str], check: bool) -> Column:
    def one(kind):
        named = F.transform(_matches(text, patterns[kind]), lambda x: F.struct(
            F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
            x["left"].alias("left"), x["right"].alias("right"), (_valid(kind, x["value"]) if check else F.lit(True)).alias("ok")))
        return F.when(F.rlike(text, F.lit(needed[kind])), named.cast(_SPANS)).otherwise(F.array().cast(_SPANS))

    return F.concat(*[one(k) for k in patterns])


def _apart(spans: Column, others: Column) -> Column:
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row id, id, base (base matches, ``ok`` where the check holds) and more (candidates and other tokens)."""
    rows = with_row_id(id_text(docs, id_col, text_col)).withColumn("text", F.coalesce("text", F.lit("")))
    has_digit = F.rlike("text", F.lit("[0-9@]|[\\[(]at[\\])]"))
    # matches refused keep their place, but for digits too few for a card: no card was refused there
    digits = lambda x: F.char_length(F.regexp_replace(x["value"], "[^0-9]", ""))
    base = F.filter(_spans(F.col("text"), BASE, NEEDED, True), lambda x: x["ok"] | (x["kind"] != "card") | (digits(x) >= CARD_DIGITS))
    # each array passes through a generator, so it is built once however often it is used below
    based = rows.where(has_digit).select(ROW_ID, "id", "text", F.explode(F.array(base)).alias("base"))
    shapes = {k: SHAPES[k] for k in SHAPES if k != "other"}
    at = {"email": r"@|[\[(]at[\])]", "ip": r":[0-9A-Fa-f]+:", "card": "[0-9]{4}[ -][0-9]{4}", "phone": "[0-9]{3}[ .-][0-9]{4}"}
    near = based.select(ROW_ID, "id", "text", "base", F.explode(F.array(_apart(_spans(F.col("text"), shapes, at, False), F.col("base")))).alias("near"))
    other = _apart(_apart(_spans(F.col("text"), {"other": SHAPES["other"]}, {"other": "[0-9]"}, False), F.col("base")), F.col("near"))
    found = near.select(ROW_ID, "id", "base", F.concat("near", other).alias("more"))
    none = rows.where(~has_digit).select(ROW_ID, "id", F.array().cast(_SPANS).alias("base"), F.array().cast(_SPANS).alias("more"))
    return found.unionByName(none)


def _patterns(left: Column, right: Column) -> Column:
    """Lexical patterns of a context: the two words before, and the words on both sides."""
    before = F.filter(F.split(F.lower(left), r"\s+"), lambda w: w != "")
    after = F.filter(F.split(F.lower(right), r"\s+"), lambda w: w != "")
    w1, w2, n1 = F.try_element_at(before, F.lit(-1)), F.try_element_at(before, F.lit(-2)), F.try_element_at(after, F.lit(1))
    return F.filter(F.array(F.concat(w2, F.lit(" "), w1, F.lit(" _")), F.concat(w1, F.lit(" _ "), n1), F.concat(w1, F.lit(" _"))),
                    lambda p: p.isNotNull())


def bootstrap(spans: DataFrame, rounds: int | None = None, min_support: int = 3, min_confidence: float = 0.8) -> DataFrame:
    """(kind, pattern): accepted patterns of ``find_spans``' result, after ``rounds`` or as many as it takes.

    Scores and confidences never fall from round to round, so they settle.
    """
    seeds = spans.select(F.inline("base")).where("ok").withColumn("seed", F.lit(True))
    rest = spans.select(F.inline("more")).withColumn("seed", F.lit(False))
    edges = materialise(seeds.unionByName(rest).select("kind", "value", "seed", F.explode(_patterns(F.col("left"), F.col("right"))).alias("pattern"))
                        .distinct(), "pii-edges")
    total = edges.groupBy("pattern").agg(F.count("*").alias("total"))
    # only patterns that a seed induced can be accepted in the end, directly or through candidates they share
    useful = edges.where("kind <> 'other'")
    scores = useful.where("seed").select("kind", "value", F.lit(1.0).alias("score")).distinct()
    accepted, mark, done = None, None, 0
    while rounds is None or done < rounds:
        held = useful.join(scores, ["kind", "value"])
        accepted = materialise(held.groupBy("kind", "pattern").agg(F.sum("score").alias("mass"), F.count("*").alias("support"))
                               .join(total, "pattern").withColumn("confidence", F.col("mass") / F.col("total"))
                               .where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
                               .select("kind", "pattern", "confidence"), "pii-patterns")
        done += 1
        after = accepted.agg(F.count("*"), F.coalesce(F.sum("confidence"), F.lit(0.0))).first()
        if mark is not None and after[0] == mark[0] and after[1] - mark[1] < 1e-6:
            break
        mark = after
        scores = materialise(useful.join(accepted, ["kind", "pattern"], "left").groupBy("kind", "value")
                             .agg(F.max(F.when(F.col("seed"), 1.0).otherwise(F.col("confidence"))).alias("score"))
                             .where("score is not null"), "pii-scores")
    return accepted.select("kind", "pattern")


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None, min_support: int = 3,
            min_confidence: float = 0.8) -> DataFrame:
    """Per row: id_col, base and added spans (arrays of kind, start, end, value), both in order of kind and start."""
    spans = materialise(find_spans(docs, id_col, text_col), "pii-spans")
    accepted = bootstrap(spans, rounds, min_support, min_confidence)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    inside = (spans.where(F.exists("more", lambda x: x["kind"] != "other")).select(ROW_ID, F.inline("more")).where("kind <> 'other'")
              .withColumn("pattern", F.explode(_patterns(F.col("left"), F.col("right")))))
    added = (inside.join(accepted, ["kind", "pattern"], "left_semi").select(ROW_ID, place.alias("place"), "start", "end", "kind", "value").distinct()
             .groupBy(ROW_ID).agg(F.sort_array(F.collect_list(F.struct("place", "start", "end", "kind", "value"))).alias("added")))

    def plain(spans_):
        return F.transform(spans_, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))

    base = F.filter("base", lambda x: x["ok"])  # the base patterns run kind by kind, each from left to right
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    return spans.join(added, ROW_ID, "left").select(
        F.col("id").alias(id_col), plain(base).alias("base"), F.coalesce(plain(F.col("added")), none).alias("added"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def merged(base: Column, added: Column) -> Column:
    """Base and added spans by kind as listed, then start."""
    both = F.concat(base, added)

    def of(kind):
        return F.array_sort(F.filter(both, lambda x: x["kind"] == kind))

    return F.concat(*[of(k) for k in KINDS])
