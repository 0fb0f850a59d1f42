"""Projects the test tables into notes, buckets and profiles (rules of FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VENUE = "Conf.cc/2030/Main"
SITE = "https://reviews.example.org"
REJECTED = f"{VENUE}/Rejected_Submission"
ORDER_RATINGS = ["quantity", "discount", "tax"]

# Fixed size at every scale: kept whole, so that joins with them can broadcast.
_DIMENSIONS = {"region", "nation"}

_NOTE_COLUMNS = ["venue_id", "forum", "id", "number", "replyto", "cdate", "seq", "signatures", "invitations", "content"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. One that is a single small file is spread over the cores; a large one is left as it is split."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if splits >= cores or name in _DIMENSIONS else df.repartition(cores)


def _json(**values: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]))


def _wrapped(value: Column) -> Column:
    return F.struct(value.alias("value"))


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


# ---- threads from conversations ----

def thread_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as forums: users review or comment, assistants answer as authors, the system is the chair."""
    turns = _table(spark, sf_dir, "conversations")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("before"))
    t = turns.join(before, ["conv_id", "turn"], "left")

    turn, text, previous = F.col("turn"), F.col("text"), F.col("before")
    forum = _text("f", F.col("conv_id").cast("string"))
    group = _text(f"{VENUE}/Submission", F.col("conv_id").cast("string"))
    first_line = F.substring_index(text, "\n", 1)
    reviewer_comment = (F.col("role") == "user") & (F.floor(turn / 2) % 2 == 1)
    review = (F.col("role") == "user") & ~reviewer_comment
    to_forum = previous.isNull() | (F.col("role") == "system") | review | (
        (F.col("role") == "assistant") & (turn % 3 == 2))
    quoting = (F.col("role") == "assistant") & ~to_forum
    body = F.when(quoting, _text("> ", F.substring_index(previous, "\n", 1), "\n\n\n\n", text)).otherwise(text)
    review_content = _json(
        summary=_wrapped(text), strengths=_wrapped(first_line), questions=_wrapped(F.lit("")),
        rating=_wrapped(F.char_length(text) % 10 + 1), confidence=F.char_length(text) % 5,
        code_of_conduct=_wrapped(F.lit("Yes")),
    )
    notes = t.select(
        F.lit(VENUE).alias("venue_id"),
        forum.alias("forum"),
        _text(forum, "_", turn.cast("string")).alias("id"),
        F.col("conv_id").alias("number"),
        F.when(to_forum, forum).otherwise(_text(forum, "_", (turn - 1).cast("string"))).alias("replyto"),
        F.when(turn % 5 != 4, F.lit(1700000000000) + turn).alias("cdate"),
        turn.cast("int").alias("seq"),
        F.array(
            F.when(F.col("role") == "system", _text(group, "/Area_Chair_s", turn.cast("string")))
            .when(F.col("role") == "assistant", _text(group, "/Authors"))
            .otherwise(_text(group, "/Reviewer_u", turn.cast("string")))
        ).alias("signatures"),
        F.array(
            F.when(review, f"{VENUE}/-/Official_Review")
            .when(F.col("role") == "system", f"{VENUE}/-/Meta_Review")
            .otherwise(f"{VENUE}/-/Official_Comment")
        ).alias("invitations"),
        F.when(review, review_content)
        .when(F.col("role") == "system", _json(summary=_wrapped(text)))
        .otherwise(_json(comment=_wrapped(body))).alias("content"),
    )
    roots = turns.select("conv_id").distinct().select(
        F.lit(VENUE).alias("venue_id"), forum.alias("forum"), forum.alias("id"), F.col("conv_id").alias("number"),
        F.lit(None).cast("string").alias("replyto"), F.lit(1700000000000).alias("cdate"), F.lit(-1).alias("seq"),
        F.array(_text(group, "/Authors")).alias("signatures"), F.array(F.lit(f"{VENUE}/-/Submission")).alias("invitations"),
        _json(title=_wrapped(_text("Paper ", F.col("conv_id").cast("string"))), venueid=_wrapped(F.lit(VENUE)),
              venue=_wrapped(F.lit("Main 2030"))).alias("content"),
    )
    return notes.unionByName(roots)


# ---- papers from orders, their reviews, decisions and meta reviews from lineitem ----

def _paper(key: str) -> Column:
    return _text("P", F.col(key).cast("string"))


def order_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One submission note per order; up to four authors counted up from the customer."""
    key, cust, priority, status = (F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"))
    reject = priority == "5-LOW"
    numbers = F.sequence(cust, cust + key % 4)
    names = F.transform(numbers, lambda i: F.concat(F.lit("Author "), i.cast("string")))
    ids = F.transform(numbers, lambda i: F.concat(F.when(i % 5 == 0, "mail").otherwise("~c"), i.cast("string")))
    shorter = F.when(key % 7 == 0, F.slice(ids, F.lit(1), F.size(ids) - 1)).otherwise(ids)
    common = dict(
        title=_wrapped(_text("Order ", key.cast("string"))),
        authors=_wrapped(names),
        authorids=_wrapped(shorter),
        abstract=_wrapped(_text("Placed ", F.date_format("o_orderdate", "yyyy-MM-dd"))),
        primary_area=status,
        # some rejected papers still carry the label of an accept bucket: they match two buckets
        venue=_wrapped(F.when(reject & (status == "P"), "Main 2030 2-HIGH").otherwise(_text("Main 2030 ", priority))),
        # open urgent orders play papers mirrored from another venue
        venueid=_wrapped(F.when(reject, REJECTED).when((priority == "1-URGENT") & (status == "O"), "Mirror.cc/2030")
                         .otherwise(VENUE)),
    )
    content = F.when(status == "F", _json(keywords=_wrapped(F.array(status, priority)), **common)).otherwise(
        _json(keywords=_wrapped(_text(status, ";", priority)), **common))
    return _table(spark, sf_dir, "orders").select(
        F.lit(VENUE).alias("venue_id"), _paper("o_orderkey").alias("forum"), _paper("o_orderkey").alias("id"),
        key.alias("number"), F.lit(None).cast("string").alias("replyto"), F.lit(0).cast("bigint").alias("cdate"),
        F.lit(-1).alias("seq"),
        F.array(_text(f"{VENUE}/Submission", key.cast("string"), "/Authors")).alias("signatures"),
        F.array(F.lit(f"{VENUE}/-/Submission")).alias("invitations"), content.alias("content"),
    )


def order_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line is a review; a returned line is also a decision, an accepted one also a meta review."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    supplier = F.col("l_suppkey").cast("string")
    forum, group = _paper("l_orderkey"), _text(f"{VENUE}/Submission", F.col("l_orderkey").cast("string"))
    base = _text(forum, "_", F.col("l_partkey").cast("string"), "_", supplier, "_", day)

    review = _json(
        review=_wrapped(_text(flag, " ", status, " ", day)), quantity=_wrapped(F.col("l_quantity").cast("int")),
        discount=F.round(F.col("l_discount") * 100).cast("int"),
        tax=_wrapped(F.round(F.col("l_tax") * 100).cast("int").cast("string")))
    decision = _json(decision=_wrapped(F.when(F.col("l_tax") == 0, "").otherwise(_text("Decided ", status))))
    meta = _json(summary=_wrapped(_text("Shipped ", day)), metareview=_wrapped(F.col("l_quantity").cast("int")))
    # a line is repeated before its notes are made, so that steps that look at the keys alone make no content
    kinds = F.when(flag == "R", F.array(F.lit("r"), F.lit("d"))).when(flag == "A", F.array(F.lit("r"), F.lit("m"))).otherwise(F.array(F.lit("r")))
    kind = F.col("kind")

    def of_kind(r: Column, d: Column, m: Column) -> Column:
        return F.when(kind == "r", r).when(kind == "d", d).otherwise(m)

    return _table(spark, sf_dir, "lineitem").select("*", F.explode(kinds).alias("kind")).select(
        F.lit(VENUE).alias("venue_id"), forum.alias("forum"), of_kind(base, _text(base, "_d"), _text(base, "_m")).alias("id"),
        F.lit(None).cast("bigint").alias("number"), forum.alias("replyto"), F.lit(None).cast("bigint").alias("cdate"),
        F.datediff(F.col("l_shipdate").cast("date"), F.lit("1990-01-01").cast("date")).alias("seq"),
        F.array(of_kind(_text(group, "/Reviewer_", supplier), F.lit(f"{VENUE}/Program_Chairs"), _text(group, "/Area_Chair_", supplier))).alias("signatures"),
        F.array(of_kind(F.lit(f"{VENUE}/-/Official_Review"), F.lit(f"{VENUE}/-/Decision"), F.lit(f"{VENUE}/-/Meta_Review"))).alias("invitations"),
        of_kind(review, decision, meta).alias("content"),
    ).select(*_NOTE_COLUMNS)


def order_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_submissions(spark, sf_dir).unionByName(order_replies(spark, sf_dir))


def order_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bucket per order priority, in priority order; the lowest priority is the reject bucket."""
    priority = F.col("o_orderpriority")
    return _table(spark, sf_dir, "orders").select(priority).distinct().select(
        F.lit(VENUE).alias("venue_id"),
        F.left(priority, F.lit(1)).cast("int").alias("ord"),
        _text("Main 2030 ", priority).alias("venue_label"),
        F.when(priority == "5-LOW", "Reject").otherwise(_text("Accept (", priority, ")")).alias("decision"),
        F.lit(REJECTED).alias("rejected_venueid"),
    )


def order_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The venue as it lands: its buckets as a heading map, the lowest priority first."""
    entry = F.struct(F.col("ord").alias("place"), F.col("venue_label").alias("key"), F.col("decision").alias("value"))
    listed = F.sort_array(F.collect_list(entry), asc=False)
    headings = F.map_from_entries(F.transform(listed, lambda e: F.struct(e["key"], e["value"])))
    return order_buckets(spark, sf_dir).groupBy("venue_id").agg(headings.alias("headings")).select(
        "venue_id", _json(decision_heading_map=_wrapped(F.col("headings")), rejected_venue_id=F.lit(REJECTED)).alias("content"))


# ---- profiles from customer and nation ----

def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile for each customer, with up to 25 entries of history."""
    key, nation = F.col("c_custkey"), F.col("n_name")

    def entry(i: Column) -> Column:
        shape = (key + i) % 8
        return F.struct(
            F.when(i % 4 != 3, _text("Position ", i.cast("string"))).alias("position"),
            F.when(i != 2, (F.lit(1990) + (key + i * 3) % 30).cast("string")).alias("start"),
            F.when(i != key % 26, (F.lit(1991) + (key + i * 3) % 30).cast("string")).alias("end"),
            F.struct(
                F.when(shape % 2 == 1, nation).alias("name"),
                F.when(F.floor(shape / 2) % 2 == 1, _text(F.lower(nation), ".example")).alias("domain"),
                F.when(shape >= 4, F.left(nation, F.lit(2))).alias("country"),
            ).alias("institution"),
        )

    link = _text("https://home.example/", key.cast("string"))
    no_link = F.lit(None).cast("string")
    names = F.when(key % 11 != 0, F.array(
        F.struct(_text(F.col("c_name"), " alt").alias("fullname"), F.lit(False).alias("preferred")),
        F.struct(F.col("c_name").alias("fullname"), (key % 3 == 0).alias("preferred")),
    ))
    segment = F.lower("c_mktsegment")
    expertise = F.array(
        F.struct(F.array(segment, F.lower(nation), segment).alias("keywords")),
        F.struct(F.when(key % 4 != 0, F.array(F.lower(nation), F.lit("trade"))).alias("keywords")),
    )
    content = F.struct(
        names.alias("names"), F.when(F.col("c_acctbal") > 5000, link).alias("homepage"),
        F.when(key % 2 == 0, link).alias("gscholar"), no_link.alias("dblp"), no_link.alias("semanticScholar"),
        F.when(key % 5 == 0, link).alias("orcid"), no_link.alias("linkedin"), no_link.alias("wikipedia"),
        no_link.alias("aclanthology"), expertise.alias("expertise"),
        F.when(key % 26 != 0, F.transform(F.sequence(F.lit(1).cast("bigint"), key % 26), entry)).alias("history"),
    )
    nations = _table(spark, sf_dir, "nation")
    customers = _table(spark, sf_dir, "customer")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        _text("~c", key.cast("string")).alias("query_id"),
        # some ids were merged into the profile before them
        _text("~c", F.when(key % 40 == 1, key - 1).otherwise(key).cast("string")).alias("id"),
        content.alias("content"),
    )


def found_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profiles of customers in credit; a customer in debt plays a profile that is not found."""
    lost = _table(spark, sf_dir, "customer").where("c_acctbal < 0").select(_text("~c", F.col("c_custkey").cast("string")).alias("query_id"))
    return customer_profiles(spark, sf_dir).join(lost, "query_id", "left_anti")


def merged_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles merged several times, over up to three hops, and some merged in a circle."""
    key = F.col("c_custkey")
    into = F.when((key % 40).isin(1, 2, 3, 11), key - 1).when(key % 40 == 10, key + 1).otherwise(key)
    return _table(spark, sf_dir, "customer").select(
        _text("~c", key.cast("string")).alias("query_id"), _text("~c", into.cast("string")).alias("id"), F.col("c_name").alias("name"))


def profile_attempts(spark: SparkSession, sf_dir: str, attempt: int) -> DataFrame:
    """What the given attempt lands: those not found before, without id where it fails again. A customer is found after
    `key % 4` failures; some that are never found are not asked a third time."""
    customers = customer_profiles(spark, sf_dir)
    key = F.substring("query_id", 3, 20).cast("bigint")
    asked = customers.where((key % 4 >= attempt - 1) & ~((key % 8 == 7) & F.lit(attempt == 3)))
    ok = key % 4 == attempt - 1
    return asked.select("query_id", F.when(ok, F.col("id")).alias("id"), F.when(ok, F.col("content")).alias("content"))


# ---- texts from documents, JSON from events ----

def quoted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    shaped = (
        F.when(F.col("doc_id") % 3 == 0, F.replace(text, F.lit("\n"), F.lit("\n> ")))
        .when(F.col("doc_id") % 3 == 1, _text("  > ", F.replace(text, F.lit("\n"), F.lit("\n\n\n\n"))))
        .otherwise(text)
    )
    return _table(spark, sf_dir, "documents").select("doc_id", shaped.alias("text"))


def event_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events hold a wrapped, a plain and a null value; odd ones their raw properties."""
    k = F.get_json_object("props", "$.k").cast("int")
    mixed = F.to_json(F.struct(_wrapped(k).alias("k"), F.col("event_type").alias("t"),
                               F.lit(None).cast("string").alias("n")), {"ignoreNullFields": "false"})
    return _table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, mixed).otherwise(F.col("props")).alias("content")
    )
