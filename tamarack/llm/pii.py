"""Personal data: patterns, and terms that reveal the persons by what they occur with.

Emails, addresses, card and phone numbers are protected entities. The corpus tells
how much a term discloses of an entity e that it occurs with: with document counts,

    information of e   IC(e) = ln(N / df(e))
    disclosure of t    (ln(N * df(t, e) / (df(t) * df(e)))) / IC(e)

which is 1 where t occurs only where e does, and 0 where they are independent. Terms
that reach a threshold are generalised in e's documents, those that disclose e in
full are removed. Terms of any length are counted and hidden over the whole texts of e's
documents. Entities that stand in the very same rows, as in a directory, have the same counts
with every term, so one of them is counted for all.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.session import materialize

# The kinds in their order, and their patterns. Possessive forms and the look
# behind find the same matches as the plain ones and keep the search linear in the text.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}  # a text without it has no match
GENERAL = {"email": "[EMAIL]", "ip": "[ADDRESS]", "card": "[CARD]", "phone": "[PHONE]"}

THRESHOLD = 0.9  # disclosure from which a term is generalised
REMOVED = 0.99  # disclosure from which it is removed
SUPPORT = 2  # different texts in which a term must occur with an entity
TERM = r"[\p{L}\p{N}]+"
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _spans(found: Column, gaps: Column, kind: str, rank: int) -> Column:
    """Matches with their places in code points, from the matches and the texts between them."""
    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("value"), F.length(g).alias("gap")))

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), pair["value"].alias("value")
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))
    return F.aggregate(pairs, zero, add)["spans"]


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    every = F.transform(F.sequence(F.lit(0), n - 1), worth)
    return F.aggregate(every, F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(span: Column) -> Column:
    """Whether a match counts: parts of an address up to 255, digits of a card and of a phone number."""
    value, kind = span["value"], span["kind"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    small = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", n.between(14, 19) & F.when(n.between(14, 19), _luhn(digits)).otherwise(F.lit(False)))
        .when(kind == "phone", n.between(10, 15))
        .otherwise(F.lit(True))
    )


def with_spans(rows: DataFrame) -> DataFrame:
    """Add ``spans``: the entities of ``text`` by start, then kind; none for null.

    Matches are a column of their own, so a text is searched once for each kind, and
    cut up only where it has matches.
    """
    none = F.array().cast("array<string>")
    text = F.col("text")
    asked = {
        f"__{kind}": F.when(
            F.contains(text, F.lit(NEEDED[kind])), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        ).otherwise(none)
        for kind in KINDS
    }
    cut = {
        f"__{kind}_gaps": F.when(F.size(f"__{kind}") > 0, F.split(text, PATTERNS[kind], -1)).otherwise(none)
        for kind in KINDS
    }
    every = [_spans(F.col(f"__{kind}"), F.col(f"__{kind}_gaps"), kind, rank) for rank, kind in enumerate(KINDS)]
    spans = F.array_sort(F.filter(F.concat(*every), _valid))
    some = F.coalesce(F.greatest(*[F.size(c) for c in asked]) > 0, F.lit(False))
    none_found = F.array().cast(_SPAN)
    done = rows.withColumns(asked).withColumns(cut).withColumn("spans", F.when(some, spans).otherwise(none_found))
    return done.drop(*asked, *cut)


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _entities(spans: str) -> Column:
    return F.array_distinct(F.transform(F.col(spans), lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))


def representatives(found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """entity and df_e: of all entities that stand in the same rows the smallest, and in how many rows.

    ``found`` has doc_id, text_id and spans. Entities in fewer than ``support`` different texts are left
    out, as no term is in as many with them. Sums of two hashes of the rows tell sets of rows apart.
    """
    rows = found.select("doc_id", "text_id", F.explode(_entities("spans")).alias("entity"))
    hashes = [F.xxhash64(F.lit(seed), "doc_id", "text_id").cast("decimal(20,0)") for seed in (1, 2)]
    texts = rows.groupBy("entity", "text_id").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(h).alias(f"h{i}") for i, h in enumerate(hashes)]
    )
    sets = texts.groupBy("entity").agg(
        F.sum("rows").alias("df_e"), F.count(F.lit(1)).alias("texts"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1")
    )
    often = sets.filter(F.col("texts") >= support)
    return often.groupBy("h0", "h1", "df_e").agg(F.min("entity").alias("entity")).select("entity", "df_e")


def disclosing(found: DataFrame, docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """entity, term and disclosure of the terms that reach the threshold, for :func:`representatives`.

    ``found`` has doc_id, text_id, text and spans; ``docs``, over which terms are
    counted, text. Counts are of rows; ``support`` counts different texts, so copies of
    one text are no evidence. An entity that is in every document has nothing to disclose.
    """
    total = docs.agg(F.count(F.lit(1)).alias("total")).scalar()
    entities = materialize(representatives(found, support).filter(F.col("df_e") < total), "entities")
    texts = together(found, entities.select("entity")).groupBy("entity", "term", "text_id").agg(F.count(F.lit(1)).alias("rows"))
    pairs = texts.groupBy("entity", "term").agg(F.sum("rows").alias("df_te"), F.count(F.lit(1)).alias("texts"))
    pairs = materialize(pairs.filter(F.col("texts") >= support), "pairs")
    counted = docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    joined = pairs.join(entities, "entity").join(counted, "term").withColumn("total", total)
    information = F.log(F.col("total") / F.col("df_e"))
    mutual = F.log(F.col("total") * F.col("df_te") / (F.col("df_t") * F.col("df_e")))
    scored = joined.withColumn("disclosure", mutual / information)
    return scored.filter(F.col("disclosure") >= threshold).select("entity", "term", "disclosure")


def together(found: DataFrame, entities: DataFrame) -> DataFrame:
    """doc_id, text_id, entity and term of all terms of the rows that hold one of ``entities``."""
    rows = found.select("doc_id", "text_id", _entities("spans").alias("entities"), _terms(F.col("text")).alias("terms"))
    held = rows.select("doc_id", "text_id", "terms", F.explode("entities").alias("entity")).join(entities, "entity", "left_semi")
    return held.select("doc_id", "text_id", "entity", F.explode("terms").alias("term"))


def find_pii(
    docs: DataFrame, threshold: float = THRESHOLD, removed: float = REMOVED, support: int = SUPPORT
) -> tuple[DataFrame, DataFrame]:
    """Entities of every row, and the terms to hide in some.

    The first table has doc_id, text_id, spans, and text where there are spans, for
    every row; the second doc_id, text_id and ``hidden`` (term and whether it is
    removed), once for each doc_id and text with such terms.
    """
    rows = with_spans(docs.select("doc_id", F.xxhash64("text").alias("text_id"), "text"))
    rows = materialize(rows.withColumn("text", F.when(F.size("spans") > 0, F.col("text"))), "found")
    found = rows.filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_id"])
    flagged = materialize(disclosing(found, docs, threshold, support), "disclosing")
    told = together(found, flagged.select("entity").distinct()).join(flagged, ["entity", "term"])
    hidden = told.groupBy("doc_id", "text_id", "term").agg((F.max("disclosure") >= removed).alias("removed"))
    hidden = hidden.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_list(F.struct("term", "removed"))).alias("hidden"))
    return rows, materialize(hidden, "hidden")


def _with_hidden(rows: DataFrame, hidden: DataFrame) -> DataFrame:
    """Add the spans of the hidden terms; those that touch an entity are left out."""
    other = hidden.select(F.col("doc_id").alias("__doc"), F.col("text_id").alias("__text"), "hidden")
    same = rows["doc_id"].eqNullSafe(other["__doc"]) & (rows["text_id"] == other["__text"])
    joined = rows.join(other, same, "left").drop("__doc", "__text")
    names = F.transform("hidden", lambda h: h["term"])
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(names, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    none = F.array().cast("array<string>")
    listed = F.col("hidden").isNotNull()
    joined = joined.withColumn("__pattern", pattern)
    joined = joined.withColumn("__hits", F.when(listed, F.regexp_extract_all("text", "__pattern", F.lit(0))).otherwise(none))
    joined = joined.withColumn("__gaps", F.when(listed, F.split("text", F.col("__pattern"), -1)).otherwise(none))
    free = F.filter(
        _spans(F.col("__hits"), F.col("__gaps"), "term", len(KINDS)),
        lambda t: ~F.exists("spans", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])),
    )
    added = F.when(listed, free).otherwise(F.array().cast(_SPAN))
    return joined.withColumn("terms", added).drop("__pattern", "__hits", "__gaps")


def _written(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the four kinds, base_sha256 and spans of every row.

    ``spans`` lists kind:start:end of all entities and hidden terms (kind ``term``) by
    start, then kind, in code points, end exclusive; ``base_sha256`` hashes the same
    list of the entities alone. A null text counts as empty. Repeated rows give
    repeated results, a null doc_id stays, other columns are ignored.
    """
    rows, hidden = find_pii(docs)
    rows = _with_hidden(rows, hidden)

    def counted(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *map(counted, KINDS),
        F.sha2(_written(F.col("spans")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("spans", "terms"))).alias("spans"),
    )


def sanitize(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with entities and revealing terms replaced in ``text``; all columns and rows stay.

    An entity becomes the name of its kind. A term becomes [NUMBER] or [TERM], or
    nothing if it discloses an entity in full. Overlapping spans are replaced once, by
    the first. Texts without spans, null ones included, stay as they are.
    """
    plain = docs.select("doc_id", F.col(text).alias("text"))
    _, hidden = find_pii(plain)
    rows = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", F.col(text).alias("text"))
    rows = with_spans(rows.withColumn("text_id", F.xxhash64("text")))
    rows = _with_hidden(rows, hidden).withColumn("__all", F.array_sort(F.concat("spans", "terms")))

    def put(span: Column) -> Column:
        out = F.when(F.col("hidden").isNotNull() & F.exists("hidden", lambda h: (h["term"] == F.lower(span["value"])) & h["removed"]), "")
        out = out.when(span["value"].rlike("^[0-9]+$"), "[NUMBER]").otherwise("[TERM]")
        for kind in KINDS:
            out = F.when(span["kind"] == kind, GENERAL[kind]).otherwise(out)
        return out

    def write(state: Column, span: Column) -> Column:
        apart = span["start"] >= state["at"]
        piece = F.concat(F.substring(F.col("text"), state["at"] + 1, span["start"] - state["at"]), put(span))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], F.array(piece))).otherwise(state["out"]).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    # A column of its own: it is used twice, and computed only where there is something to hide.
    rows = rows.withColumn("__folded", F.when(F.size("__all") > 0, F.aggregate("__all", zero, write)))
    rest = F.substring(F.col("text"), F.col("__folded.at") + 1, F.length("text"))
    whole = F.concat(F.array_join("__folded.out", ""), rest)
    clean = F.when(F.col("__folded").isNotNull(), whole).otherwise(F.col("text"))
    return rows.withColumn("__clean", clean).select(
        *[F.col("__clean").alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns]
    )
