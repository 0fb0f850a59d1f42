"""SQL over the raw test tables that each query must match."""

from __future__ import annotations

VENUE = "Conf.cc/2030/Main"
SITE = "https://reviews.example.org"
# reviews of the widest paper and entries of the longest history at the scale of the comparison (sf0.01)
WIDEST_PAPER = 13
LONGEST_HISTORY = 25

NL = "chr(10)"


def own_text(text: str) -> str:
    """Quoted lines dropped, blank runs collapsed, ends stripped."""
    kept = f"array_to_string(list_filter(string_split({text}, {NL}), lambda x: NOT regexp_matches(x, '^\\s*>')), {NL})"
    collapsed = f"regexp_replace(coalesce({kept}, ''), '\\n{{3,}}', {NL} || {NL}, 'g')"
    return f"regexp_replace({collapsed}, '^\\s+|\\s+$', '', 'g')"


# ---- threads ----

TURNS = f"""
shaped AS (
  SELECT c.conv_id, c.turn, c.role, c.text, p.text AS before, 'f' || c.conv_id AS forum,
    'f' || c.conv_id || '_' || c.turn AS id,
    CASE WHEN c.role = 'system' THEN 'meta_review' WHEN c.role = 'assistant' THEN 'reply'
      WHEN (c.turn // 2) % 2 = 1 THEN 'comment' ELSE 'official_review' END AS k
  FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
),
t AS (
  SELECT *,
    CASE WHEN before IS NULL OR k IN ('meta_review', 'official_review') OR (k = 'reply' AND turn % 3 = 2)
      THEN forum ELSE 'f' || conv_id || '_' || (turn - 1) END AS replyto,
    CASE k WHEN 'meta_review' THEN '{VENUE}/Submission' || conv_id || '/Area_Chair_s' || turn
      WHEN 'reply' THEN '{VENUE}/Submission' || conv_id || '/Authors'
      ELSE '{VENUE}/Submission' || conv_id || '/Reviewer_u' || turn END AS signature,
    CASE WHEN k = 'reply' AND NOT (before IS NULL OR turn % 3 = 2)
      THEN '> ' || split_part(before, {NL}, 1) || repeat({NL}, 4) || text ELSE text END AS body,
    CASE WHEN turn % 5 = 4 THEN 0 ELSE 1700000000000 + turn END AS posted,
    'Reviewer u' || turn AS reviewer,
    split_part(text, {NL}, 1) AS line
  FROM shaped
),
roots AS (
  SELECT DISTINCT conv_id, 'f' || conv_id AS forum, '{VENUE}/Submission' || conv_id || '/Authors' AS signature FROM t
),
replies AS (
  SELECT * FROM (SELECT *, {own_text('body')} AS own FROM t WHERE k = 'reply' AND body <> '')
),
"""

WALK = """
walk(reply_id, forum, cur, hop) AS (
  SELECT id, forum, replyto, 1 FROM replies
  UNION ALL
  SELECT w.reply_id, w.forum, n.replyto, w.hop + 1
  FROM walk w JOIN t n ON n.forum = w.forum AND n.id = w.cur AND n.k <> 'official_review' WHERE w.hop < 12
),
targets AS (
  SELECT w.reply_id, w.cur AS target FROM walk w JOIN t n ON n.id = w.cur AND n.k = 'official_review'
)
"""

SEPARATOR = f"{NL} || {NL} || '---' || {NL} || {NL}"
REVIEW_TEXT = f"""concat_ws({NL} || {NL}, CASE WHEN text <> '' THEN 'Summary:' || {NL} || text END,
  CASE WHEN line <> '' THEN 'Strengths:' || {NL} || line END)"""
THREAD_RATINGS = "'confidence=' || (length(text) % 5) || ',rating=' || (length(text) % 10 + 1)"
REBUTTALS = f"""
rebuttals AS (
  SELECT g.target AS note_id, string_agg(r.own, {SEPARATOR} ORDER BY r.posted, r.turn, r.id) AS rebuttal_text
  FROM replies r JOIN targets g ON g.reply_id = r.id WHERE r.own <> '' GROUP BY 1
)
"""


def threads(select: str, *more: str) -> str:
    return "WITH RECURSIVE " + TURNS + ",\n".join([WALK, *more]) + select


def _reviews_with_rebuttals() -> str:
    return threads(f"""
SELECT t.forum, t.id AS note_id, reviewer, {REVIEW_TEXT} AS full_text, {THREAD_RATINGS} AS ratings,
  coalesce(b.rebuttal_text, '') AS rebuttal_text
FROM t LEFT JOIN rebuttals b ON b.note_id = t.id WHERE t.k = 'official_review'""", REBUTTALS)


def _incremental_papers() -> str:
    return threads(f"""
SELECT t.forum, row_number() OVER (PARTITION BY t.forum ORDER BY reviewer, turn, t.id) AS review_idx, reviewer,
  {REVIEW_TEXT} AS full_text, {THREAD_RATINGS} AS ratings, coalesce(b.rebuttal_text, '') AS rebuttal_text
FROM t LEFT JOIN rebuttals b ON b.note_id = t.id WHERE t.k = 'official_review'""", REBUTTALS)


INVITATION = f"""CASE k WHEN 'official_review' THEN '{VENUE}/-/Official_Review'
  WHEN 'meta_review' THEN '{VENUE}/-/Meta_Review' ELSE '{VENUE}/-/Official_Comment' END"""
SORTED_KEYS = """CASE k WHEN 'official_review' THEN 'code_of_conduct,confidence,questions,rating,strengths,summary'
  WHEN 'meta_review' THEN 'summary' ELSE 'comment' END"""
KEYS = """CASE k WHEN 'official_review' THEN 'summary,strengths,questions,rating,confidence,code_of_conduct'
  WHEN 'meta_review' THEN 'summary' ELSE 'comment' END"""
KIND = "CASE WHEN k IN ('official_review', 'meta_review') THEN k ELSE 'other' END"


def _thread_sql() -> dict[str, str]:
    return {
        "reviews_with_rebuttals": _reviews_with_rebuttals(),
        "incremental_papers": _incremental_papers(),
        "general_response": threads(f"""
SELECT r.forum, string_agg(r.own, {SEPARATOR} ORDER BY r.posted, r.turn, r.id) AS general_response
FROM replies r LEFT JOIN targets g ON g.reply_id = r.id WHERE g.target IS NULL AND r.own <> '' GROUP BY 1"""),
        "resolve_target_review": threads("""
SELECT r.forum, r.id, r.replyto, g.target FROM replies r LEFT JOIN targets g ON g.reply_id = r.id"""),
        "reply_parent": threads("""
SELECT t.forum, t.id, coalesce(p.signature, o.signature) AS parent_signature FROM t
LEFT JOIN t p ON p.id = t.replyto LEFT JOIN roots o ON o.forum = t.replyto
UNION ALL SELECT forum, forum, NULL FROM roots"""),
        "scan_notes": threads("""
SELECT forum, id, replyto, turn AS seq FROM t UNION ALL SELECT forum, forum, NULL, -1 FROM roots"""),
        "forum_notes": "SELECT 'f' || conv_id AS forum, count(*) + 1 AS notes FROM conversations GROUP BY 1",
        "note_kinds": threads(f"""
SELECT {KIND} AS kind, k = 'reply' AND body <> '' AS is_reply, {INVITATION} AS invitation,
  {SORTED_KEYS} AS content_keys, count(*) AS notes FROM t GROUP BY 1, 2, 3, 4
UNION ALL SELECT 'submission', false, '{VENUE}/-/Submission', 'title,venue,venueid', count(*) FROM roots"""),
        "note_listing": threads(f"""
SELECT id, replyto, signature, {INVITATION} AS invitation, {KEYS} AS content_keys FROM t
UNION ALL SELECT forum, NULL, signature, '{VENUE}/-/Submission', 'title,venueid,venue' FROM roots"""),
        "loose_note_kinds": threads(f"""
SELECT {KIND} AS kind, count(*) AS notes FROM t GROUP BY 1
UNION ALL SELECT 'submission', count(*) FROM roots"""),
        "first_of_kind": threads(f"""
SELECT kind, forum, id, signature, content_keys FROM (
  SELECT {KIND} AS kind, forum, id, signature, {KEYS} AS content_keys,
    row_number() OVER (PARTITION BY {KIND} ORDER BY conv_id, turn, id) AS rn FROM t
  UNION ALL SELECT 'submission', forum, forum, signature, 'title,venueid,venue',
    row_number() OVER (ORDER BY conv_id) FROM roots) WHERE rn = 1"""),
        "first_examples": threads(f"""
, noted AS (
  SELECT *, row_number() OVER (PARTITION BY {KIND} ORDER BY conv_id, turn, id) AS rn,
    row_number() OVER (PARTITION BY k = 'reply' AND body <> '' ORDER BY conv_id, turn, id) AS reply_rn FROM t
),
chosen AS (
  SELECT {KIND} AS kind, * FROM noted WHERE rn = 1
  UNION ALL SELECT 'author_reply', * FROM noted WHERE k = 'reply' AND body <> '' AND reply_rn = 1
),
first_root AS (SELECT * FROM roots ORDER BY conv_id LIMIT 1)
SELECT kind, id, signature, position, key, value FROM (
  SELECT kind, id, signature, e.position, e.key,
    CASE e.key WHEN 'summary' THEN text WHEN 'strengths' THEN line WHEN 'questions' THEN ''
      WHEN 'rating' THEN '' || (length(text) % 10 + 1) WHEN 'confidence' THEN '' || (length(text) % 5) ELSE 'Yes' END AS value
  FROM chosen, (VALUES (0, 'summary'), (1, 'strengths'), (2, 'questions'), (3, 'rating'), (4, 'confidence'), (5, 'code_of_conduct')) e(position, key)
  WHERE kind = 'official_review'
  UNION ALL SELECT kind, id, signature, 0, 'summary', text FROM chosen WHERE kind = 'meta_review'
  UNION ALL SELECT kind, id, signature, 0, 'comment', body FROM chosen WHERE kind IN ('other', 'author_reply')
  UNION ALL SELECT 'submission', forum, signature, e.position, e.key,
    CASE e.key WHEN 'title' THEN 'Paper ' || conv_id WHEN 'venueid' THEN '{VENUE}' ELSE 'Main 2030' END
  FROM first_root, (VALUES (0, 'title'), (1, 'venueid'), (2, 'venue')) e(position, key))"""),
        "restart": threads(f"""
SELECT 1 AS version, forum, id AS note_id, '' AS rebuttal_text FROM t WHERE k = 'official_review' AND turn % 2 = 0
UNION ALL SELECT 2, t.forum, t.id, coalesce(b.rebuttal_text, '') FROM t LEFT JOIN (
  SELECT g.target AS note_id, string_agg(r.own, ' | ' ORDER BY r.posted, r.turn, r.id) AS rebuttal_text
  FROM replies r JOIN targets g ON g.reply_id = r.id WHERE r.own <> '' GROUP BY 1) b ON b.note_id = t.id
WHERE t.k = 'official_review'"""),
        "two_venues_one_slug": threads(f"""
SELECT v.venue_id, v.p || substr(t.forum, 2) AS forum, v.p || substr(t.id, 2) AS note_id, reviewer, {THREAD_RATINGS} AS ratings,
  coalesce(b.rebuttal_text, '') AS rebuttal_text
FROM t LEFT JOIN rebuttals b ON b.note_id = t.id, (VALUES ('{VENUE}', 'f'), ('{VENUE.replace("/Main", "_Main")}', 'g')) v(venue_id, p)
WHERE t.k = 'official_review'""", REBUTTALS),
        "stitch_review_text": threads(f"""
SELECT id AS note_id, reviewer, {REVIEW_TEXT} AS full_text FROM t WHERE k = 'official_review'"""),
        "stitch_meta_text": threads(f"""
SELECT id, 'Area Chair s' || turn AS handle,
  CASE WHEN text <> '' THEN 'Summary:' || {NL} || text ELSE '' END AS meta_review_text
FROM t WHERE k = 'meta_review'"""),
        "stitch_reply_text": threads("SELECT id, posted, own AS text FROM replies WHERE own <> ''"),
        "discover_rating_fields": threads("""
SELECT f.field, count(*) AS n_reviews, min(f.position) AS position
FROM t, (VALUES ('rating', 0), ('confidence', 1)) f(field, position) WHERE k = 'official_review' GROUP BY 1"""),
        "sample_rating_fields": threads("""
SELECT f.field, f.position FROM (VALUES ('rating', 0), ('confidence', 1)) f(field, position)
WHERE EXISTS (SELECT 1 FROM t WHERE k = 'official_review' AND conv_id = (SELECT min(conv_id) FROM roots))"""),
        "rating_audit": threads("""
SELECT note_id, reviewer, field, CASE WHEN length(v) > 60 THEN left(v, 60) || '...' ELSE v END AS shown, field_class
FROM (
  SELECT id AS note_id, reviewer, 'summary' AS field, text AS v, 'text' AS field_class FROM t WHERE k = 'official_review'
  UNION ALL SELECT id, reviewer, 'strengths', line, 'text' FROM t WHERE k = 'official_review'
  UNION ALL SELECT id, reviewer, 'questions', '', 'text' FROM t WHERE k = 'official_review'
  UNION ALL SELECT id, reviewer, 'rating', '' || (length(text) % 10 + 1), 'rating' FROM t WHERE k = 'official_review'
  UNION ALL SELECT id, reviewer, 'confidence', '' || (length(text) % 5), 'rating' FROM t WHERE k = 'official_review'
  UNION ALL SELECT id, reviewer, 'code_of_conduct', 'Yes', 'housekeeping' FROM t WHERE k = 'official_review')"""),
    }


# ---- texts and JSON ----

SHAPED_DOCS = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN replace(text, {NL}, {NL} || '> ')
    WHEN doc_id % 3 = 1 THEN '  > ' || replace(text, {NL}, repeat({NL}, 4)) ELSE text END AS text FROM documents
)
"""


def _text_sql() -> dict[str, str]:
    return {
        "strip_quoted_text": SHAPED_DOCS + f"SELECT doc_id, {own_text('text')} AS text FROM d",
        "text_excerpts": SHAPED_DOCS + """
SELECT doc_id, CASE WHEN text = '' THEN '_(empty)_'
    WHEN length(s) > 600 THEN regexp_replace(left(s, 600), '\\s+$', '') || ' ...' ELSE s END AS excerpt,
  CASE WHEN length(text) > 60 THEN left(text, 60) || '...' ELSE text END AS shortened
FROM (SELECT *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s FROM d)""",
        "content_value": """
SELECT event_id, json_extract_string(props, '$.k') AS k,
  CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'none' END AS t, 'none' AS n,
  json_extract_string(props, '$.k') <> '0' AS k_truthy, event_id % 2 = 0 AS has_n FROM events""",
    }


# ---- papers ----

ORDERS = f"""
lines AS (
  SELECT *, 'P' || l_orderkey AS forum, strftime(l_shipdate, '%Y-%m-%d') AS day,
    date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS seq,
    'P' || l_orderkey || '_' || l_partkey || '_' || l_suppkey || '_' || strftime(l_shipdate, '%Y-%m-%d') AS id,
    'Reviewer ' || l_suppkey AS reviewer
  FROM lineitem
),
reviews AS (
  SELECT forum, row_number() OVER (PARTITION BY l_orderkey ORDER BY reviewer, seq, id) AS review_idx, reviewer,
    'Review:' || {NL} || l_returnflag || ' ' || l_linestatus || ' ' || day AS full_text,
    '' || CAST(l_quantity AS INT) AS quantity, '' || CAST(round(l_discount * 100) AS INT) AS discount,
    '' || CAST(round(l_tax * 100) AS INT) AS tax
  FROM lines
),
decisions AS (
  SELECT forum, arg_max('Decided ' || l_linestatus, (seq, id || '_d')) AS decision
  FROM lines WHERE l_returnflag = 'R' AND l_tax <> 0 GROUP BY 1
),
metas AS (
  SELECT forum, arg_max('Summary:' || {NL} || 'Shipped ' || day || {NL} || {NL} || 'Metareview:' || {NL}
      || CAST(l_quantity AS INT), (seq, id || '_m')) AS meta_review_text,
    arg_max('Area Chair ' || l_suppkey, (seq, id || '_m')) AS meta_reviewer_handle
  FROM lines WHERE l_returnflag = 'A' GROUP BY 1
),
subs AS (
  SELECT *, 'P' || o_orderkey AS forum, '{SITE}/forum?id=P' || o_orderkey AS link, 'Order ' || o_orderkey AS title,
    CASE WHEN o_orderstatus = 'F' THEN o_orderstatus || ', ' || o_orderpriority
      ELSE o_orderstatus || ';' || o_orderpriority END AS keywords,
    'Placed ' || strftime(o_orderdate, '%Y-%m-%d') AS abstract, o_orderstatus AS primary_area,
    'Main 2030 ' || CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '2-HIGH'
      ELSE o_orderpriority END AS venue,
    CASE WHEN o_orderpriority = '5-LOW' THEN '{VENUE}/Rejected_Submission'
      WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'Mirror.cc/2030' ELSE '{VENUE}' END AS venueid,
    range(o_custkey, o_custkey + o_orderkey % 4 + 1 - CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) AS listed
  FROM orders
),
author_cells AS (
  SELECT *,
    coalesce(array_to_string(list_transform(listed, lambda i: 'Author ' || i ||
      CASE WHEN i % 5 = 0 THEN '' ELSE ' ({SITE}/profile?id=~c' || i || ')' END), '; '), '') AS authors,
    coalesce(array_to_string(list_transform(list_filter(listed, lambda i: i % 5 <> 0), lambda i: '~c' || i), ','), '')
      AS author_ids
  FROM subs
),
buckets AS (
  SELECT DISTINCT CAST(left(o_orderpriority, 1) AS INT) AS ord, 'Main 2030 ' || o_orderpriority AS venue_label,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'Reject' ELSE 'Accept (' || o_orderpriority || ')' END AS bucket,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'Reject'
      ELSE 'Accept_' || replace(replace(o_orderpriority, '-', '_'), ' ', '_') END AS slug
  FROM orders
),
candidates AS (
  SELECT s.*, b.ord, b.bucket, b.slug FROM author_cells s JOIN buckets b
  ON (b.bucket = 'Reject' AND s.venueid = '{VENUE}/Rejected_Submission')
    OR (b.bucket <> 'Reject' AND s.venue = b.venue_label)
  WHERE starts_with(s.venueid, '{VENUE}')
),
counted AS (
  SELECT c.*, coalesce(n.n, 0) AS n_reviews FROM candidates c
  LEFT JOIN (SELECT forum, count(*) AS n FROM lines GROUP BY 1) n ON n.forum = c.forum
),
papers AS (
  SELECT c.*, coalesce(d.decision, c.bucket) AS type, coalesce(m.meta_review_text, '') AS meta_review_text,
    coalesce(m.meta_reviewer_handle, '') AS meta_reviewer_handle, '' AS general_response
  FROM (
    SELECT * FROM counted WHERE NOT (bucket = 'Reject' AND n_reviews = 0)
    QUALIFY row_number() OVER (PARTITION BY forum ORDER BY ord) = 1
  ) c LEFT JOIN decisions d ON d.forum = c.forum LEFT JOIN metas m ON m.forum = c.forum
)
"""
ORDER_RATINGS = "'discount=' || discount || ',quantity=' || quantity || ',tax=' || tax"
ORDER_LABELS = "'Discount=' || discount || ',Quantity=' || quantity || ',Tax=' || tax"


def orders(select: str) -> str:
    return "WITH " + ORDERS + select


def _wide_reviews() -> str:
    blocks, columns = [], []
    for n in range(1, WIDEST_PAPER + 1):
        for name, column in (("Review", "full_text"), ("Reviewer", "reviewer")):
            columns.append(f"coalesce(w.{column}{n}, '') AS \"{name} {n}\"")
            blocks.append(f"max({column}) FILTER (review_idx = {n}) AS {column}{n}")
        columns.append(f"'' AS \"Rebuttal {n}\"")
        for rating in ("quantity", "discount", "tax"):
            columns.append(f"coalesce(w.{rating}{n}, '') AS \"Review {n} {rating.title()}\"")
            blocks.append(f"max({rating}) FILTER (review_idx = {n}) AS {rating}{n}")
    return orders(f"""
SELECT link, title, authors, keywords, abstract, primary_area, '' || o_orderkey AS submission_number, type,
  meta_review_text AS "Meta Review", meta_reviewer_handle AS "Meta Reviewer", general_response AS "General Response",
  {', '.join(columns)}
FROM papers p LEFT JOIN (SELECT forum, {', '.join(blocks)} FROM reviews GROUP BY 1) w ON w.forum = p.forum""")


def _paper_sql() -> dict[str, str]:
    return {
        "decision_and_meta": orders("""
SELECT coalesce(d.forum, m.forum) AS forum, decision, meta_review_text, meta_reviewer_handle
FROM decisions d FULL JOIN metas m ON m.forum = d.forum"""),
        "submission_columns": orders("""
SELECT forum, link, title, keywords, abstract, primary_area, o_orderkey AS submission_number, venue, venueid
FROM subs"""),
        "format_authors": orders("SELECT forum, authors, author_ids FROM author_cells"),
        "split_author_cells": orders("""
SELECT author, count(*) AS papers FROM (SELECT unnest(string_split(authors, '; ')) AS author FROM author_cells)
WHERE author <> '' GROUP BY 1"""),
        "distinct_author_ids": orders("""
SELECT DISTINCT author_id FROM (SELECT unnest(string_split(author_ids, ',')) AS author_id FROM (
  SELECT '' || array_to_string(list_transform(list_filter(
    range(o_custkey, o_custkey + o_orderkey % 4 + 1 - CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END),
    lambda i: i % 5 <> 0), lambda i: '~c' || i), ',') AS author_ids FROM orders)) WHERE author_id <> ''"""),
        "assign_bucket": orders("""
SELECT forum, bucket, ord FROM candidates QUALIFY row_number() OVER (PARTITION BY forum ORDER BY ord) = 1"""),
        "top_n_per_bucket": orders("""
SELECT forum, bucket, o_orderkey AS number FROM candidates
QUALIFY row_number() OVER (PARTITION BY ord ORDER BY o_orderkey, forum) <= 100"""),
        "drop_reject_without_reviews": orders("SELECT forum, bucket, n_reviews FROM papers"),
        "top_5000_per_bucket": orders("""
SELECT forum, bucket, o_orderkey AS number FROM candidates
QUALIFY row_number() OVER (PARTITION BY ord ORDER BY o_orderkey, forum) <= 5000"""),
        "buckets_from_groups": orders(f"""
SELECT CAST(row_number() OVER (ORDER BY ord DESC) - 1 AS INT) AS ord, venue_label, bucket AS decision,
  '{VENUE}/Rejected_Submission' AS rejected_venueid FROM buckets"""),
        "pending_forums": orders("SELECT forum FROM subs ANTI JOIN papers USING (forum)"),
        "sample_papers": orders("SELECT forum, type FROM papers ORDER BY o_orderkey, forum LIMIT 20"),
        "bucket_files_both": orders("SELECT link, title, authors, abstract, type, meta_review_text AS meta FROM papers"),
        "paper_rows": orders("""
SELECT forum, type, bucket, meta_review_text, meta_reviewer_handle, general_response, n_reviews FROM papers"""),
        "long_reviews": orders(f"""
SELECT forum, review_idx, reviewer, full_text, {ORDER_RATINGS} AS ratings FROM reviews"""),
        "max_reviews_per_bucket": orders("SELECT bucket, max(n_reviews) AS max_reviews FROM papers GROUP BY 1"),
        "bucket_counts": orders("""
SELECT bucket, slug AS bucket_slug, count(*) AS papers, max(n_reviews) AS max_reviews FROM papers GROUP BY 1, 2"""),
        "wide_reviews": _wide_reviews(),
        "unpivot_wide": orders(f"""
SELECT link, review_idx, reviewer, full_text, {ORDER_LABELS} AS ratings FROM papers p
JOIN reviews r ON r.forum = p.forum"""),
        "first_per_type": orders("""
SELECT type, link, rtrim(left(abstract, 8)) || ' ...' AS abstract FROM papers
QUALIFY row_number() OVER (PARTITION BY type ORDER BY o_orderkey, forum) = 1"""),
        "first_match_or_first": orders("""
SELECT 'found' AS "case", arg_min(link, (type <> 'Decided O', o_orderkey)) AS link,
  arg_min(type, (type <> 'Decided O', o_orderkey)) AS type FROM papers
UNION ALL SELECT 'missing', arg_min(link, o_orderkey), arg_min(type, o_orderkey) FROM papers"""),
        "venue_label_counts": orders("""
SELECT b.venue_label, count(s.forum) AS submissions FROM buckets b LEFT JOIN subs s ON s.venue = b.venue_label
GROUP BY 1"""),
        "key_contains": orders("""
SELECT forum, 'venue' AS key, venue AS value FROM subs UNION ALL SELECT forum, 'venueid', venueid FROM subs"""),
        "csv_roundtrip": orders(f"""
SELECT forum, title, '' || o_orderkey AS submission_number, meta_review_text AS meta,
  '"q", ' || authors || {NL} || 'next' AS authors FROM papers"""),
        "bucket_files_union": orders("SELECT link, title, type, n_reviews AS reviews FROM papers"),
        "jsonl_reviews": orders(f"""
SELECT p.forum, CAST(row_number() OVER (PARTITION BY p.forum ORDER BY reviewer, seq, id) - 1 AS INT) AS place, reviewer AS reviewer_handle,
  '{VENUE}/Submission' || l_orderkey || '/Reviewer_' || l_suppkey AS reviewer_signature, id AS note_id,
  'Review:' || {NL} || l_returnflag || ' ' || l_linestatus || ' ' || day AS full_text,
  'discount=' || CAST(round(l_discount * 100) AS INT) || ',quantity=' || CAST(l_quantity AS INT) || ',tax=' || CAST(round(l_tax * 100) AS INT) AS ratings,
  '' AS rebuttal_text
FROM papers p JOIN lines l ON l.forum = p.forum"""),
        "incremental_paper_rows": orders("""
SELECT forum, type, bucket, title, keywords, meta_review_text, meta_reviewer_handle, n_reviews FROM papers"""),
        "incremental_top_n": orders("""
SELECT forum, bucket, n_reviews FROM (
  SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY ord ORDER BY o_orderkey, forum) <= 100)
WHERE NOT (bucket = 'Reject' AND n_reviews = 0) QUALIFY row_number() OVER (PARTITION BY forum ORDER BY ord) = 1"""),
        "jsonl_roundtrip": orders("""
SELECT p.forum, type, bucket, n_reviews AS reviews, r.reviewer, r.full_text AS text, r.quantity
FROM papers p LEFT JOIN reviews r ON r.forum = p.forum AND r.review_idx = 1"""),
    }


# ---- authors ----

PROFILES = f"""
profiles AS (
  SELECT c_custkey AS key, '~c' || c_custkey AS query_id,
    '~c' || CASE WHEN c_custkey % 40 = 1 THEN c_custkey - 1 ELSE c_custkey END AS id, n_name,
    CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN c_name ELSE c_name || ' alt' END AS name,
    concat_ws('; ', CASE WHEN c_acctbal > 5000 THEN 'Homepage (https://home.example/' || c_custkey || ')' END,
      CASE WHEN c_custkey % 2 = 0 THEN 'Google Scholar (https://home.example/' || c_custkey || ')' END,
      CASE WHEN c_custkey % 5 = 0 THEN 'ORCID (https://home.example/' || c_custkey || ')' END) AS links,
    lower(c_mktsegment) || '; ' || lower(n_name) || CASE WHEN c_custkey % 4 <> 0 THEN '; trade' ELSE '' END AS expertise,
    c_acctbal
  FROM customer JOIN nation ON n_nationkey = c_nationkey
),
found AS (SELECT * FROM profiles WHERE c_acctbal >= 0),
parts AS (
  SELECT p.*, i, CASE WHEN (key + i) % 2 = 1 THEN n_name ELSE '' END AS nm,
    CASE WHEN ((key + i) % 8 // 2) % 2 = 1 THEN lower(n_name) || '.example' ELSE '' END AS dm,
    CASE WHEN (key + i) % 8 >= 4 THEN left(n_name, 2) ELSE '' END AS cn
  FROM profiles p, range(1, {LONGEST_HISTORY + 1}) r(i) WHERE i <= key % 26
),
based AS (
  SELECT *, CASE WHEN dm = '' THEN nm WHEN nm = '' THEN dm ELSE nm || ' (' || dm || ')' END AS base FROM parts
),
history AS (
  SELECT key, i AS history_idx, CASE WHEN i % 4 <> 3 THEN 'Position ' || i ELSE '' END AS title,
    CASE WHEN cn = '' THEN base WHEN base = '' THEN cn ELSE base || ' [' || cn || ']' END AS location,
    CASE WHEN i <> 2 THEN '' || (1990 + (key + i * 3) % 30) ELSE '' END AS start,
    CASE WHEN i <> key % 26 THEN '' || (1991 + (key + i * 3) % 30) ELSE 'Present' END AS "end"
  FROM based
),
ids AS (
  SELECT DISTINCT '~c' || i AS author_id FROM (
    SELECT unnest(range(o_custkey, o_custkey + o_orderkey % 4 + 1)) AS i, o_orderkey % 7 = 0 AS cut,
      o_custkey + o_orderkey % 4 AS last FROM orders) WHERE i % 5 <> 0 AND NOT (cut AND i = last)
)
"""


def authors(select: str) -> str:
    return "WITH " + PROFILES + select


def _author_table() -> str:
    columns, blocks = [], []
    for n in range(1, LONGEST_HISTORY + 1):
        for f in ("title", "location", "start", "end"):
            blocks.append(f"max(\"{f}\") FILTER (history_idx = {n}) AS {f}_{n}")
            columns.append(f"coalesce(w.{f}_{n}, '') AS \"History {n} {f.title()}\"")
    return authors(f"""
SELECT '{SITE}/profile?id=' || id AS "Link", name AS "Name", links AS "Personal Links", expertise AS "Expertise",
  {', '.join(columns)}
FROM profiles p LEFT JOIN (SELECT key, {', '.join(blocks)} FROM history GROUP BY 1) w ON w.key = p.key""")


def _author_sql() -> dict[str, str]:
    link = f"'{SITE}/profile?id=' || id AS \"Link\""
    history = f"""
SELECT {link}, name AS "Name", history_idx, title, location, start, "end" FROM profiles p JOIN history h ON h.key = p.key"""
    return {
        "author_table": _author_table(),
        "long_history": authors(history),
        "scan_profiles": authors(history),
        "unpivot_history": authors(history + " WHERE title <> ''"),
        "manifest_profiles": authors("SELECT author_id, id FROM ids JOIN found ON query_id = author_id"),
        "missing_profiles": authors("SELECT author_id FROM ids ANTI JOIN found ON query_id = author_id"),
        "id_manifest_roundtrip": authors("SELECT author_id FROM ids"),
        "paper_authors": authors(f"""
SELECT {link}, arg_min(name, query_id) AS "Name", arg_min(key % 26, query_id) AS entries
FROM ids JOIN found ON query_id = author_id GROUP BY id"""),
        "merged_profile_chains": """
WITH merged AS (
  SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 40 IN (1, 2, 3, 11) THEN c_custkey - 1
    WHEN c_custkey % 40 = 10 THEN c_custkey + 1 ELSE c_custkey END AS target FROM customer
),
ended AS (
  SELECT *, CASE WHEN k % 40 IN (1, 2, 3) THEN k - k % 40 WHEN k % 40 = 11 THEN k - 1
    WHEN k % 40 = 10 AND k + 1 NOT IN (SELECT k FROM merged) THEN k + 1 ELSE k END AS profile FROM merged
)
SELECT '~c' || profile AS id, arg_min('~c' || k, (target <> profile, '~c' || k)) AS query_id, arg_min(name, (target <> profile, '~c' || k)) AS name,
  count(*) AS ids FROM ended GROUP BY profile""",
        "profile_retries": """
SELECT '~c' || k AS query_id, k % 4 < 3 AS found, CAST(least(k % 4 + 1, CASE WHEN k % 8 = 7 THEN 2 ELSE 3 END) AS BIGINT) AS attempts,
  k % 8 = 7 AS pending, CASE WHEN k % 4 = 3 THEN '' WHEN k % 40 = 1 THEN '~c' || (k - 1) ELSE '~c' || k END AS id
FROM (SELECT c_custkey AS k FROM customer)""",
        "profile_key_census": authors("""
SELECT key, count(*) AS rows FROM (
  SELECT 'names' AS key FROM profiles WHERE key % 11 <> 0
  UNION ALL SELECT 'homepage' FROM profiles WHERE c_acctbal > 5000
  UNION ALL SELECT 'gscholar' FROM profiles WHERE key % 2 = 0
  UNION ALL SELECT 'orcid' FROM profiles WHERE key % 5 = 0
  UNION ALL SELECT 'expertise' FROM profiles
  UNION ALL SELECT 'history' FROM profiles WHERE key % 26 <> 0) GROUP BY 1"""),
        "parquet_text_roundtrip": authors(f"""
SELECT {link}, name AS "Name", expertise AS "Expertise", '' || (key % 26) AS entries FROM profiles"""),
        "incremental_profiles": authors(f"""
SELECT {link}, name AS "Name", 'done' AS state FROM ids JOIN found ON query_id = author_id
UNION ALL SELECT '{SITE}/profile?id=' || author_id, '', 'pending' FROM ids ANTI JOIN found ON query_id = author_id"""),
    }


def all_sql() -> dict[str, str]:
    return {**_thread_sql(), **_text_sql(), **_paper_sql(), **_author_sql()}
