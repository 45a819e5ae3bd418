"""Personal data: fixed forms, and bootstrapped contextual extraction; built-in functions only.

The fixed forms (e-mail, IP address, payment card, phone number) give the seed
entities. Each seed induces lexical patterns: its kind with the word, and the
two words, to the left. Patterns and the values met behind them form a graph
that is scored in turns: a pattern is as good as the distinct values known
behind it, against those that contradict it (of another kind, or of a shape that
the kind cannot have); a value as good as its best pattern. A value that is not
known yet counts a little against a pattern. Patterns above a threshold find values
in other forms that the fixed ones miss (a phone number without country code,
a card number that fails its check digit, an e-mail address written out), and
these are seeds of the next turn, until no pattern is added.

Offsets are code points; a span is [start, end). Every quantifier that could
run over a long word is possessive or starts behind a look-behind, so time
grows with the length of the text, not with its square.

Nulls: a null text counts as empty. Rows with equal text and equal or null id
are treated alike; every row is returned, other columns stay, whatever their names.
An empty table has an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.rows import folded, unfolded
from ledgerlark.storage import write_stage

KINDS = ("email", "ip", "card", "phone")
LEAST_CONFIDENCE = 0.8
LEAST_SEEDS = 3
UNKNOWN = 0.05  # weight of a value that is not known against a pattern
PRIOR = 0.5
LOSS = 0.9
ONE_PHRASE = 3

# The same matches as the plain forms of the contract: \G or the look-behind skips only starts that cannot match.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_HINTS = {
    "email": r"@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][ -]?[0-9]",
    "phone": r"\+[0-9]",
}
# Values that only a learned pattern can confirm: runs of digits, and addresses that are written out.
_OTHER = (
    r"(?<![A-Za-z0-9+@._/=-])\(?[0-9][0-9(). -]{4,}[0-9]"
    r"|(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]++)++"
)
_OTHER_HINT = r"[0-9][0-9(). -]{4}|[(\[]at[)\]]"
_BLOCK = 64
_FOUND = "array<struct<start:int,end:int,from:int,to:int,value:string,patterns:array<string>>>"
_GAPS = "array<struct<gap:int,chars:int,gap_bytes:int,bytes:int,value:string,patterns:array<string>>>"


def with_matches(rows: DataFrame, name: str, form: str, hint: str) -> DataFrame:
    """rows (text, ...) with an array `name` of all matches of a form in the text.

    A match has its code points [start, end), its bytes [from, to), its value and the patterns to its left.
    A text is scanned only if the cheaper `hint` is found in it. Places are sums over what lies before: over
    blocks of matches, then inside the block, so time grows with the length of the text and not with its square.
    """
    parts, blocks, before = (f"{name}_{x}" for x in ("parts", "blocks", "before"))
    found = F.arrays_zip(
        F.split("text", form).alias("gap"), F.regexp_extract_all(F.col("text"), F.lit(form), F.lit(0)).alias("value")
    )
    sized = F.transform(
        F.filter(found, lambda x: x["value"].isNotNull()),
        lambda x: F.struct(
            F.char_length(x["gap"]).alias("gap"),
            (F.char_length(x["gap"]) + F.char_length(x["value"])).alias("chars"),
            F.octet_length(x["gap"]).alias("gap_bytes"),
            (F.octet_length(x["gap"]) + F.octet_length(x["value"])).alias("bytes"),
            x["value"],
            _patterns(x["gap"]).alias("patterns"),
        ),
    )

    def total(items: Column) -> Column:
        zero = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("bytes"))
        return F.aggregate(
            items,
            zero,
            lambda t, x: F.struct((t["chars"] + x["chars"]).alias("chars"), (t["bytes"] + x["bytes"]).alias("bytes")),
        )

    def every(count: Column, make) -> Column:
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), make)).otherwise(F.array())

    def placed(x: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        inside = total(F.slice(parts, block * _BLOCK + 1, i % _BLOCK))
        chars = F.get(before, block)["chars"] + inside["chars"]
        octets = F.get(before, block)["bytes"] + inside["bytes"]
        return F.struct(
            (chars + x["gap"]).alias("start"),
            (chars + x["chars"]).alias("end"),
            (octets + x["gap_bytes"]).alias("from"),
            (octets + x["bytes"]).alias("to"),
            x["value"],
            x["patterns"],
        )

    # every step reads the one before more than once, so that none is evaluated anew for each match
    count = F.ceil(F.size(parts) / _BLOCK).cast("int")
    return (
        rows.withColumn(parts, F.when(F.col("text").rlike(hint), sized).otherwise(F.array().cast(_GAPS)))
        .withColumn(blocks, every(count, lambda b: total(F.slice(parts, b * _BLOCK + 1, F.lit(_BLOCK)))))
        .withColumn(before, every(F.size(blocks), lambda b: total(F.slice(blocks, F.lit(1), b))))
        .withColumn(name, F.when(F.size(before) > 0, F.transform(parts, placed)).otherwise(F.array().cast(_FOUND)))
        .drop(parts, blocks, before)
    )


def passes_luhn(digits: Column) -> Column:
    """Check digit of a card number given as digits."""

    def add(total: Column, place: Column) -> Column:
        digit = F.try_to_number(F.substr(digits, -place, F.lit(1)), F.lit("9")).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda x: F.ltrim(x, F.lit("0"))
        return F.forall(
            F.split(value, r"\."),
            lambda x: (F.char_length(part(x)) < 3) | ((F.char_length(part(x)) == 3) & (part(x) <= "255")),
        )
    if kind == "card":
        digits = _digits(value)
        return F.when(F.char_length(digits).between(16, 19), passes_luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(value)).between(8, 15)
    return F.lit(True)


def with_base(rows: DataFrame) -> DataFrame:
    """rows with an array `base` of the fixed forms, by kind, then start: the matches with `kind`, a place in KINDS."""
    columns = rows.columns
    found = []
    for number, kind in enumerate(KINDS):
        rows = with_matches(rows, f"of_{kind}", FORMS[kind], _HINTS[kind])
        found.append(_valid(f"of_{kind}", number, kind))
    return rows.select(*columns, F.concat(*found).alias("base"))


def _valid(matches: str, number: int, kind: str) -> Column:
    """The matches that pass the checks of their kind."""
    return F.transform(F.filter(matches, lambda x: _is_valid(kind, x["value"])), lambda x: _span(F.lit(number), x))


def _span(kind: Column, x: Column) -> Column:
    fields = ("start", "end", "from", "to", "value", "patterns")
    return F.struct(kind.cast("int").alias("kind"), *[x[f].alias(f) for f in fields])


def possible_kinds(value: Column) -> Column:
    """Places in KINDS that a value in another form may have, judged by its shape."""
    n = F.char_length(_digits(value))
    kinds = F.array(
        F.when(value.rlike(r"[(\[]at[)\]]"), 0),
        F.when(value.rlike(r"^[0-9]+( ?\. ?[0-9]+){3}$"), 1),
        F.when(n.between(12, 19), 2),
        F.when(n.between(7, 15), 3),
    )
    return F.array_compact(kinds)


def _patterns(left: Column) -> Column:
    """The last word and the last two words, in lower case, with their punctuation."""
    words = F.filter(F.split(F.lower(left), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    last = F.slice(F.concat(F.array(F.lit(None).cast("string")), F.reverse(words)), 2, 2)
    return F.transform(F.array_compact(F.array(F.get(last, F.lit(0)), F.get(last, F.lit(1)))), lambda x, i: F.when(
        i == 0, x).otherwise(F.concat(x, F.lit(" "), F.get(last, F.lit(0)))))


def trusted_patterns(
    facts: DataFrame, least_confidence: float = LEAST_CONFIDENCE, least_seeds: int = LEAST_SEEDS
) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that the pattern-instance graph confirms.

    `facts` has a row per occurrence: pattern, wider (for a pattern of one word, the one of two words around it),
    value, kind (null for a value in another form) and may (places in KINDS that its shape allows). Confidence of
    a pattern for a kind: the summed scores of the distinct values of the kind behind it, over that sum, the number
    of values that contradict it, `UNKNOWN` for every value that is not known, and `PRIOR`. A seed has score 1; a
    value that was found has the confidence of the best pattern that has found it times `LOSS`, and is of that
    pattern's kind from then on. A pattern of one word whose known values all stand behind one phrase of two words
    needs `ONE_PHRASE` times as many: a phrase says little about its last word alone.
    """
    edges = write_stage(
        facts.groupBy("pattern", "value").agg(
            F.min("kind").alias("kind"), F.first("may").alias("may"), F.min("wider").alias("first"), F.max("wider").alias("last")
        ),
        "pattern_edges",
    )
    labelled = edges.withColumn("score", F.lit(1.0))
    trusted, n_trusted = None, 0
    while True:
        of = {k: F.col("kind") == k for k in range(len(KINDS))}
        against = {k: F.when(F.col("kind").isNull(), ~F.array_contains("may", k)).otherwise(~of[k]) for k in of}
        sums = [
            F.struct(
                F.lit(k).alias("kind"),
                F.count_if(of[k]).alias("seeds"),
                F.coalesce(F.sum(F.when(of[k], F.col("score"))), F.lit(0.0)).alias("good"),
                F.count_if(against[k]).alias("bad"),
                F.count_if(F.col("kind").isNull() & F.array_contains("may", k)).alias("unknown"),
                F.min(F.when(of[k], F.col("first"))).alias("first"),
                F.max(F.when(of[k], F.col("last"))).alias("last"),
            )
            for k in of
        ]
        several = F.contains("pattern", F.lit(" ")) | (F.col("s.first") != F.col("s.last"))
        against_all = F.col("s.good") + F.col("s.bad") + UNKNOWN * F.col("s.unknown") + PRIOR
        sure = (
            labelled.groupBy("pattern")
            .agg(F.array(*sums).alias("sums"))
            .select("pattern", F.explode("sums").alias("s"))
            .where(F.col("s.seeds") >= F.when(several, least_seeds).otherwise(ONE_PHRASE * least_seeds))
            .select("pattern", "s.kind", (F.col("s.good") / against_all).alias("confidence"))
            .where(F.col("confidence") >= least_confidence)
        )
        if trusted is not None:  # what was trusted stays, with the confidence that it was trusted for
            sure = trusted.unionByName(sure.join(trusted, ["pattern", "kind"], "left_anti"))
        trusted = write_stage(sure, "patterns")
        n = trusted.count()
        if n == n_trusted:
            return trusted
        n_trusted = n
        best = F.max(F.struct("confidence", (-F.col("kind")).alias("kind"))).alias("best")
        found = (
            edges.where("kind is null")
            .select("pattern", "value", F.explode("may").alias("kind"))
            .join(trusted, ["pattern", "kind"])
            .groupBy("value")
            .agg(best)
            .select("value", (-F.col("best.kind")).alias("_kind"), (F.col("best.confidence") * LOSS).alias("_score"))
        )
        labelled = write_stage(
            edges.join(found, "value", "left").select(
                "pattern",
                F.coalesce("kind", "_kind").alias("kind"),
                "may",
                "first",
                "last",
                F.when(F.col("kind").isNull(), F.col("_score")).otherwise(1.0).alias("score"),
            ),
            "pattern_labels",
        )


def _apart(seen: DataFrame) -> DataFrame:
    """Spans of fixed forms, and those of the other spans that overlap none of them."""
    of_text, fixed = Window.partitionBy("doc_id", "row_hash"), F.col("kind").isNotNull()
    # both windows grow from their first row: one that ends with the last row would be computed anew for each
    forth = of_text.orderBy(F.asc("start"), F.asc_nulls_last("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = of_text.orderBy(F.desc("start"), F.desc_nulls_first("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.max(F.when(fixed, F.col("end"))).over(forth)
    after = F.min(F.when(fixed, F.col("start"))).over(back)
    free = (F.coalesce("_before", F.lit(0)) <= F.col("start")) & (F.coalesce("_after", F.col("end")) >= F.col("end"))
    return seen.withColumns({"_before": before, "_after": after}).where(fixed | free).drop("_before", "_after")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, row_hash, base, spans) per row of docs (doc_id, text).

    base and spans are arrays of (kind, start, end, from, to) by kind, then start: code points [start, end) and bytes
    [from, to). spans has the base spans and those that learned patterns add.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_matches(with_base(rows), "other", _OTHER, _OTHER_HINT)
    rows = write_stage(rows.select("doc_id", F.xxhash64("text").alias("row_hash"), "base", "other"), "spans")
    other = F.transform("other", lambda x: F.struct(_span(F.lit(None), x).alias("x"), possible_kinds(x["value"]).alias("may")))
    fixed = F.transform("base", lambda x: F.struct(x.alias("x"), F.array(x["kind"]).alias("may")))
    seen = rows.select("doc_id", "row_hash", F.explode(F.concat(fixed, other)).alias("s"))
    seen = _apart(seen.select("doc_id", "row_hash", "s.x.*", "s.may"))
    facts = seen.select("*", F.posexplode("patterns").alias("words", "pattern")).withColumn(
        "wider", F.when(F.col("words") == 0, F.coalesce(F.get("patterns", F.lit(1)), F.lit("")))
    )
    trusted = trusted_patterns(facts).select("pattern", "kind")
    place = ["kind", "start", "end", "from", "to"]
    added = (
        facts.where("kind is null")
        .select("doc_id", "row_hash", *place[1:], "pattern", F.explode("may").alias("kind"))
        .join(trusted, ["pattern", "kind"])
        .groupBy("doc_id", "row_hash")
        .agg(F.sort_array(F.collect_set(F.struct(*place))).alias("added"))
        .withColumnsRenamed({"doc_id": "id", "row_hash": "hash"})
    )
    base = F.transform("base", lambda x: F.struct(*[x[p].alias(p) for p in place]))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_hash") == F.col("hash"))
    return rows.join(added, same, "left").select(
        "doc_id",
        "row_hash",
        base.alias("base"),
        F.when(F.col("added").isNull(), base).otherwise(F.sort_array(F.concat(base, F.col("added")))).alias("spans"),
    )


def written(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def _marks(found: DataFrame) -> DataFrame:
    """(id, hash, marks) per text with spans: the places to replace, (from, to, kind) in order; spans that overlap are one."""
    spans = found.where("size(spans) > 0").dropDuplicates(["doc_id", "row_hash"])
    spans = spans.select(F.col("doc_id").alias("id"), F.col("row_hash").alias("hash"), F.explode("spans").alias("s"))
    spans = spans.select("id", "hash", "s.from", "s.to", "s.kind")
    of_text = Window.partitionBy("id", "hash").orderBy("from", "to", "kind")
    before = F.max("to").over(of_text.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.coalesce(before, F.lit(0)) <= F.col("from")).cast("int")
    group = F.sum("opens").over(of_text.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = spans.withColumn("opens", opens).withColumn("group", group).groupBy("id", "hash", "group")
    first = F.min(F.struct("from", "to", "kind"))
    places = merged.agg(first.alias("first"), F.max("to").alias("to"))
    place = F.struct(F.col("first.from").alias("from"), "to", F.col("first.kind").alias("kind"))
    return places.groupBy("id", "hash").agg(F.sort_array(F.collect_list(place)).alias("marks"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in capitals and brackets; spans that overlap become one."""
    marks = _marks(find(docs.select("doc_id", "text")))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("hash"))
    rows = folded(docs).join(marks, same, "left")

    def masked(data: Column) -> Column:
        def part(begin: Column, length: Column) -> Column:
            return F.substr(data, begin + 1, length).cast("string")  # of bytes: its time is its own length

        def piece(x: Column, i: Column) -> Column:
            begin = F.coalesce(F.get("marks", i - 1)["to"], F.lit(0))
            return F.concat(part(begin, x["from"] - begin), F.get(names, x["kind"]))

        last = F.element_at("marks", -1)["to"]
        return F.array_join(F.concat(F.transform("marks", piece), F.array(part(last, F.octet_length(data) - last))), "")

    # a list of one, so that the bytes are taken once for a text and not once for every span
    whole = F.get(F.transform(F.array(F.col("text").cast("binary")), masked), F.lit(0))
    return unfolded(rows, docs, F.when(F.col("marks").isNull(), F.col("text")).otherwise(whole))
