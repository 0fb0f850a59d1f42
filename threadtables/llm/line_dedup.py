"""Near-duplicate lines by MinHash over character shingles, all in DataFrame functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadtables.llm.components import connected
from threadtables.llm.ranks import group_slots
from threadtables.session import scratch, stage

#: Characters of a shingle.
SHINGLE = 8
#: A pair at similarity 0.8 shares one of the bands with odds of about 0.999, at 0.85 of 0.9999.
BANDS, ROWS = 10, 3
#: Shingles fall into classes by their hash; each class has its own bands, so a shingle is met by few functions only.
CLASSES = 5
PER_CLASS = BANDS // CLASSES * ROWS
#: Longs that hold a byte of each value of a signature, one for each class.
WORDS = CLASSES
#: Longs of the parity sketch of a line's shingle set, 64 bits in each.
PARITIES = 16
_NO_ID = -(1 << 63)


_LOW = (1 << 32) - 1


def _factors() -> list[int]:
    """Odd numbers of 31 bits; a 32-bit value times one of them, modulo 2^32, is an order of its own."""
    state, out = 1, []
    for _ in range(PER_CLASS):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(state >> 33 | 1)
    return out


def _print(doc_id: Column, text: Column) -> Column:
    """64 bits of a text and of whether its row has an id."""
    return F.xxhash64(doc_id.isNull(), text)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows by doc_id (the least long for null) and `crc`, the print of the row."""
    doc = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc, F.lit(_NO_ID)).alias("id"), _print(doc, F.col("text")).alias("crc"), "text", doc.alias("doc_id"))


def _lines(docs: DataFrame) -> DataFrame:
    """id, crc, pos, h1, h2, line: each line that is not blank, with a fingerprint of 128 bits."""
    lines = _keyed(docs).select("id", "crc", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where("trim(line) <> ''")
    return lines.select("id", "crc", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"), "line")


def _last_start(line: Column) -> Column:
    return F.greatest(F.lit(0), F.char_length(line) - SHINGLE)


def _shingle(encoded: Column, at: Column) -> Column:
    """Four bytes for each character, so that any shingle is found at once."""
    return F.substring(encoded, at * 4 + 1, SHINGLE * 4)


def _signed(lines: DataFrame) -> DataFrame:
    """line_id, class, bands, w: for each class that a line has shingles of, the bands of their least values, and a sketch
    of these. Shingles are hashed and their least values taken as they come.

    Within a class values are those of MinHash; over the classes they are drawn without replacement, so the odds are no
    worse than those of functions that all meet every shingle.
    """
    # in a step of its own, or each shingle would encode the line anew
    encoded = lines.select("line_id", F.encode("line", "UTF-32").alias("encoded"), _last_start(F.col("line")).alias("last"))
    rows = encoded.select("line_id", "encoded", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("at"))
    hashed = rows.select("line_id", F.xxhash64(_shingle(F.col("encoded"), F.col("at"))).alias("x"))
    hashed = hashed.select("line_id", F.pmod(F.shiftrightunsigned("x", 32), F.lit(CLASSES)).alias("class"), F.col("x").bitwiseAND(F.lit(_LOW)).alias("h"))
    least = hashed.groupBy("line_id", "class").agg(*(F.min((F.col("h") * F.lit(f)).bitwiseAND(F.lit(_LOW))).alias(f"m{i}") for i, f in enumerate(_factors())))
    bands = F.array(*(F.xxhash64("class", F.lit(b), *(f"m{b * ROWS + r}" for r in range(ROWS))) for b in range(BANDS // CLASSES)))
    return least.select("line_id", "class", bands.alias("bands"), _word().alias("w"))


def _banded(lines: DataFrame) -> DataFrame:
    """line_id, band: a row for each band of each line."""
    return _signed(lines).select("line_id", F.explode("bands").alias("band"))


def _word(w: int = 0) -> Column:
    """A byte of each of the signature's next PER_CLASS values in one long."""
    return reduce(Column.bitwiseOR, [F.shiftleft(F.col(f"m{w * PER_CLASS + i}").bitwiseAND(F.lit(255)), 8 * i) for i in range(PER_CLASS)])


def _words(signed: DataFrame) -> DataFrame:
    """line_id, w0..: the sketches of a line's classes side by side, null for a class without shingles."""
    return signed.groupBy("line_id").agg(*(F.max(F.when(F.col("class") == c, F.col("w"))).alias(f"w{c}") for c in range(WORDS)))


def _differing(one: str, two: str) -> Column:
    """In how many values two sketches differ: the bytes of their XOR that are not 0, counted in a few steps for each long.
    A class that one of them lacks does not count."""
    low, high = F.lit(0x7F7F7F7F7F7F), F.lit(0x808080808080)
    xors = [F.col(f"{one}.w{w}").bitwiseXOR(F.col(f"{two}.w{w}")) for w in range(WORDS)]
    return reduce(Column.__add__, [F.coalesce(F.bit_count((x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseAND(high)), F.lit(0)) for x in xors])


def may_differ(percent: int) -> int:
    """Values of the signature that two lines may differ in: at 80 percent 17 of 30, which leaves out 2 of a million pairs
    that are just similar enough, far fewer than share no band."""
    n, p = BANDS * ROWS, percent / 100
    return n - max(0, int(n * p - 5 * (n * p * (1 - p)) ** 0.5))


def _shingles(line: str) -> Column:
    places = F.sequence(F.lit(0), _last_start(F.col(line)))
    # the outer function binds the encoded line, or each shingle would encode it anew
    once = F.transform(F.array(F.encode(line, "UTF-32")), lambda encoded: F.transform(places, lambda at: F.xxhash64(_shingle(encoded, at))))
    return F.array_distinct(F.get(once, F.lit(0)))


def _parities(lines: DataFrame) -> DataFrame:
    """line_id, size, x0..: the number of different shingles and, for each of 64 * PARITIES places, whether an odd
    number of them falls there."""
    rows = lines.select("line_id", F.explode(_shingles("line")).alias("h"))
    place = F.col("h").bitwiseAND(F.lit(64 * PARITIES - 1)).cast("int")
    rows = rows.select("line_id", F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    words = (F.bit_xor(F.when(F.col("word") == x, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(f"x{x}") for x in range(PARITIES))
    return rows.groupBy("line_id").agg(F.count("*").alias("size"), *words)


def _may_be_similar(one: str, two: str, percent: int) -> Column:
    """Whether two sets may overlap by `percent`, without any doubt if not: a place whose parity differs needs a shingle
    that only one set holds, and similar sets hold at most (100 - percent) / (100 + percent) of both sizes of these."""
    both = (F.col(f"{one}.size") + F.col(f"{two}.size")) * (100 - percent)
    odd = reduce(Column.__add__, [F.bit_count(F.col(f"{one}.x{x}").bitwiseXOR(F.col(f"{two}.x{x}"))) for x in range(PARITIES)])
    return ((100 + percent) * F.abs(F.col(f"{one}.size") - F.col(f"{two}.size")) <= both) & ((100 + percent) * odd <= both)


def _verified(pairs: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """The pairs whose shingle sets overlap by `percent` of their union."""
    side = lambda x: lines.select(F.col("line_id").alias(x), F.col("line").alias(f"line_{x}"))
    texts = pairs.join(side("a"), "a").join(side("b"), "b")
    sets = texts.select("a", "b", _shingles("line_a").alias("sa"), _shingles("line_b").alias("sb"))
    counted = sets.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("both"), (F.size("sa") + F.size("sb")).alias("sum"))
    return counted.where(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b")


def similar_lines(lines: DataFrame, percent: int = 80) -> DataFrame:
    """a, b: links between different lines (line_id, line) that connect all similar lines that share a band.

    The lines of each band are ranked, those first that meet most others. In each round the next ranks of every band
    (1, then 3, 12, 48, ...) are probes: each is compared with all lines ranked after it that are not yet in its
    component, first by sketches, inside the join, and then exactly; what leaves the join is little but similar pairs.
    A line that was linked stays a probe for the rest. A band is left once the lines not yet probed are in one
    component, so in the end every pair of each band was compared or is connected.
    """
    sketch = [*(f"w{w}" for w in range(WORDS)), "size", *(f"x{x}" for x in range(PARITIES))]
    with scratch(lines.sparkSession, "signatures"):
        signed = stage(_signed(lines), "signatures")
        # counted where they are, so that bands are moved once
        bands = signed.select("line_id", F.explode("bands").alias("band")).withColumn("n", F.count("*").over(Window.partitionBy("band")))
        shared = stage(bands.where("n > 1"), "shared-bands")
        order = shared.groupBy("line_id").agg((-F.sum("n")).alias("order"))
        near_lines = stage(lines.join(order, "line_id", "left_semi"), "near-lines")  # only lines that share a band are ever compared
        words = _words(signed.select("line_id", "class", "w").join(order, "line_id", "left_semi"))
        sketches = stage(words.join(_parities(near_lines), "line_id"), "sketches")
    ranked = group_slots(shared.select("band", "line_id").join(order, "line_id"), ["band"], ["order", "line_id"], "rank")
    columns = ["band", "line_id", "rank", *sketch]
    active = stage(ranked.join(sketches, "line_id").select(*columns, F.col("line_id").alias("root")), "bands")
    links = active.select(F.col("line_id").alias("a"), F.col("root").alias("b")).limit(0)
    compared, probed = None, 1
    while not active.isEmpty():
        probes = active.where(F.col("rank") < probed).select("band", F.col("line_id").alias("probe"), F.col("rank").alias("at"), F.col("root").alias("own"), *sketch)
        close = _may_be_similar("x", "p", percent) & (_differing("x", "p") <= may_differ(percent))
        pairs = active.alias("x").join(probes.alias("p"), (F.col("x.band") == F.col("p.band")) & (F.col("rank") > F.col("at")) & (F.col("root") != F.col("own")) & close)
        pairs = pairs.select(F.least("line_id", "probe").alias("a"), F.greatest("line_id", "probe").alias("b")).distinct()
        pairs = stage(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti"), "line-pairs")
        compared = pairs if compared is None else compared.unionByName(pairs)
        found = stage(_verified(pairs, near_lines, percent), "line-links")
        rest = active.where(F.col("rank") >= probed)
        if not found.isEmpty():
            links = stage(connected(links.unionByName(found)).select(F.col("node").alias("a"), F.col("root").alias("b")), "line-groups")
            rest = rest.drop("root").join(links.withColumnRenamed("a", "line_id"), "line_id", "left")
            rest = rest.select(*columns, F.coalesce("b", "line_id").alias("root"))
        parted = rest.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
        active = stage(rest.join(parted, "band", "left_semi"), "bands")
        probed *= 4
    return links


def dedup_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_lines, n_removed, text: every document with one line kept of each group of similar lines.

    Lines end at \\n. Two lines are similar if the sets of their 8-character shingles (a shorter line is one shingle)
    overlap by `percent` of the union; groups are connected over all documents, and the line of the smallest doc_id and
    place stays. Blank lines are never removed. A null text stays null with no lines. A null doc_id counts as the
    smallest. Rows equal in doc_id and text are one document: each keeps the same lines. Extra columns are ignored.
    """
    return dedup_texts(docs, percent).drop("crc")


def dedup_texts(docs: DataFrame, percent: int = 80) -> DataFrame:
    """`dedup_lines` with crc, the print of the row as it was."""
    lines = _lines(docs)
    kinds = lines.groupBy("h1", "h2", "line").agg(F.count("*").alias("n")).withColumn("line_id", F.monotonically_increasing_id())
    with scratch(docs.sparkSession, "lines"):
        kinds = stage(kinds, "lines")
        roots = connected(similar_lines(kinds.select("line_id", "line"), percent))
        grouped = roots.select(F.col("node").alias("line_id"), "root").unionByName(roots.select(F.col("root").alias("line_id"), "root").distinct())
        marked = kinds.select("h1", "h2", "n", "line_id").join(grouped, "line_id", "left").where("root is not null or n > 1")
        marked = marked.select("h1", "h2", F.coalesce("root", "line_id").alias("line_group"))
        places = stage(lines.drop("line").join(marked, ["h1", "h2"]).select("id", "crc", "pos", "line_group"), "line-places")
    first = places.groupBy("line_group").agg(F.min(F.struct("id", "crc", "pos")).alias("kept"))
    gone = places.join(first, "line_group").where("not (id = kept.id and crc = kept.crc and pos = kept.pos)")
    gone = gone.groupBy("id", "crc").agg(F.collect_set("pos").alias("gone"))
    text = F.split("text", "\n")
    # the outer function binds the parted text, or each line would part it anew
    left = F.transform(F.array("parts"), lambda own: F.transform(F.array_except(F.sequence(F.lit(0), F.size(own) - 1), "gone"), lambda i: F.get(own, i)))
    rows = _keyed(docs).join(gone, ["id", "crc"], "left").withColumn("parts", text)
    return rows.select(
        "doc_id", "crc", F.coalesce(F.size("parts"), F.lit(0)).alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.get(left, F.lit(0)), "\n")).alias("text"))


def drop_emptied(docs: DataFrame, deduped: DataFrame) -> DataFrame:
    """`docs` with the texts of `deduped` and their other columns (`n_chars`, if there, is counted anew).

    A document that lost lines and has only blanks left is dropped; one that had no more from the start stays. With the
    crc of `dedup_texts` a row is known by doc_id, null or not, and text; without it (`dedup_lines`) one text for each
    doc_id is needed and rows without doc_id stay as they are.
    """
    new = deduped.where("n_removed > 0").withColumnRenamed("doc_id", "key").withColumnRenamed("text", "left")
    if "crc" in deduped.columns:
        own = F.col("row.doc_id").cast("long").eqNullSafe(F.col("key")) & (_print(F.col("row.doc_id"), F.col("row.text")) == F.col("crc"))
        new = new.select("key", "crc", "left").distinct()
    else:
        own = F.col("row.doc_id") == F.col("key")
        new = new.where("key is not null").select("key", "left").distinct()
    rows = docs.select(F.struct("*").alias("row")).join(new, own, "left")
    rows = rows.where(F.col("left").isNull() | F.col("left").rlike(r"\S"))
    changed = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("left").cast(docs.schema["n_chars"].dataType)
    return rows.select(*(
        F.when(F.col("left").isNull(), F.col("row")[c]).otherwise(changed[c]).alias(c) if c in changed else F.col("row")[c].alias(c)
        for c in docs.columns))
