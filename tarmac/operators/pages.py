"""Extraction from stored pages (X1-X5) and the row-order operators of the
scrapers (W5 header-date carry-forward, W6 day rollover, W8 date spine).

Scraper cores re-aimed as batch jobs over a ``pages`` table; everything is
regex + array functions + windows inside segments of a page's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.operators import ranking

HREF = r'href="([^"]*)"'
ROW = r"(?s)<tr[^>]*>(.*?)</tr>"
CELL = r"(?s)<td[^>]*>(.*?)</td>"
TAG = r"<[^>]+>"


# X1
def extract_links(pages: DataFrame, allow: DataFrame, allow_col: str = "key") -> DataFrame:
    """Distinct hrefs whose last path segment is in the allow-list (a
    left-semi join; Spark broadcasts the list where it is small)."""
    links = pages.select(F.explode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("href"))
    links = links.withColumn("key", C.url_key("href"))
    a = allow.select(F.col(allow_col).alias("key")).distinct()
    return links.join(a, "key", "left_semi").select("href").distinct()


# X2
def extract_table_rows(pages: DataFrame, drop_blank: bool = True) -> DataFrame:
    """(page_id, pos, cells): one row per ``<tr>``, cell texts stripped of
    inner tags and trimmed; blank cells dropped in the list variant."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(ROW), 1)).alias("pos", "tr"))
    cells = F.transform(F.regexp_extract_all("tr", F.lit(CELL), 1),
                        lambda x: F.trim(F.regexp_replace(x, TAG, "")))
    if drop_blank:
        cells = F.filter(cells, lambda x: x != "")
    return rows.select("page_id", "pos", cells.alias("cells"))


# W5
def carry_header_dates(rows: DataFrame, rows_per_bucket: int = ranking.ROWS_PER_BUCKET) -> DataFrame:
    """Single-cell rows are date headers: each multi-cell row takes the last
    header above it on its page (commas removed from the header text). A page
    of very many rows is split over tasks."""
    header = F.when(F.size("cells") == 1, F.regexp_replace(F.col("cells")[0], ",", ""))
    out = ranking.carried(rows, "page_id", "pos", header, "header_date", rows_per_bucket)
    return out.filter(F.size("cells") > 1)


# X3
def extract_comments(pages: DataFrame, css_class: str = "content", key_col: str = "url") -> DataFrame:
    """Texts of ``<div class="<css_class>">`` blocks, commas -> blanks, with
    the page key (last URL segment) appended. A block ends at its own close
    tag: divs inside are counted. A block that is never closed gives nothing;
    a block of the class inside another is part of the outer one."""
    start = rf'(?s)^<div class="{css_class}"[^>]*>'
    cut = F.split("html", r"(?=<div\b)|(?=</div>)")  # each piece begins with the tag it is cut at
    held = pages.select(C.url_key(key_col).alias("airport"), F.explode(F.array(cut)).alias("pieces"))
    tags = F.transform("pieces", lambda p, i: F.struct(
        i.alias("i"), p.rlike(start).alias("starts"), F.when(p.rlike(r"^<div\b"), 1).when(p.startswith("</div>"), -1).otherwise(0).alias("step")))
    # Of the open block only its first piece and depth are kept, of a closed one its first piece and the one after its last.
    new = lambda done, depth, a: F.struct(done.alias("done"), depth.alias("depth"), a.alias("a"))

    def step(s, x):
        return F.when(s["depth"] == 0, F.when(x["starts"], new(s["done"], F.lit(1), x["i"])).otherwise(s)) \
            .when((x["step"] == -1) & (s["depth"] == 1), new(F.concat(s["done"], F.array(F.struct(s["a"].alias("a"), x["i"].alias("b")))), F.lit(0), F.lit(0))) \
            .otherwise(new(s["done"], s["depth"] + x["step"], s["a"]))

    found = F.aggregate(tags, new(F.array().cast("array<struct<a:int,b:int>>"), F.lit(0), F.lit(0)), step, lambda s: s["done"])
    blocks = held.select("airport", "pieces", F.explode(found).alias("f"))
    block = F.array_join(F.slice("pieces", F.col("f.a") + 1, F.col("f.b") - F.col("f.a")), "")
    text = F.trim(F.regexp_replace(F.regexp_replace(block, TAG, ""), ",", " "))
    return blocks.select(text.alias("comment"), "airport")


# X4
def extract_details(pages: DataFrame, block_tag: str = "details", item_tag: str = "li", label_class: str = "label",
                    value_class: str = "value", hour_class: str = "hour") -> DataFrame:
    """(page_id, block, hour, details): one row per ``<details>`` block of a page,
    with the block's hour label and its label/value items as a map.

    A wind item gives direction and speed with unit: its direction is the
    text of the first inner span of the value, or the value's first word, the
    speed what follows. A UV index is taken only from a second value; other
    labels become field names (lower case, blanks -> '_'). Of items with one
    name the last counts. Blocks without a usable item have an empty map."""
    block = rf"(?s)<{block_tag}[^>]*>(.*?)</{block_tag}>"
    item = rf"(?s)<{item_tag}[^>]*>(.*?)</{item_tag}>"
    hour = rf'(?s)<span class="{hour_class}"[^>]*>(.*?)</span>'
    lab = rf'(?s)<span class="{label_class}"[^>]*>(.*?)</span>'
    val = rf'(?s)<span class="{value_class}"[^>]*>((?:<span[^>]*>.*?</span>|.)*?)</span>'  # spans inside the value's span
    plain = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, TAG, " "), r"\s+", " "))
    b = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(block), 1)).alias("block", "b"))
    b = b.withColumn("hour", plain(F.regexp_extract("b", hour, 1)))
    items = b.select("page_id", "block", "hour", F.posexplode_outer(F.regexp_extract_all("b", F.lit(item), 1)).alias("pos", "li"))
    items = items.select("page_id", "block", "hour", "pos", plain(F.regexp_extract("li", lab, 1)).alias("label"),
                         F.transform(F.regexp_extract_all("li", F.lit(val), 1), plain).alias("values"))
    usable = (F.col("label") != "") & (F.size("values") > 0) & (F.get("values", F.lit(0)) != "")
    first = F.get("values", F.lit(0))
    words = F.split(first, " ", 2)
    one = lambda k, v: F.array(F.struct(k.alias("k"), v.alias("v")))
    none = F.array().cast("array<struct<k:string,v:string>>")
    entries = F.when(~usable | usable.isNull(), none) \
        .when(F.col("label").contains("Wind"), F.concat(one(F.lit("wind_direction"), F.get(words, 0)),
                                                        one(F.lit("wind_speed"), F.coalesce(F.get(words, 1), F.lit(""))))) \
        .when(F.col("label").contains("Humidity"), one(F.lit("humidity"), first)) \
        .when(F.col("label").contains("UV Index"), F.when(F.size("values") == 2, one(F.lit("uv_index"), F.get("values", F.lit(1)))).otherwise(none)) \
        .otherwise(one(C.field_name("label"), first))
    kv = items.select("page_id", "block", "hour", "pos", F.explode_outer(entries).alias("e"))
    per_key = kv.groupBy("page_id", "block", "hour", F.col("e.k").alias("k")).agg(F.max_by(F.col("e.v"), "pos").alias("v"), F.min("pos").alias("pos"))
    entry = F.when(F.col("k").isNotNull(), F.struct("pos", "k", "v"))
    blocks = per_key.groupBy("page_id", "block", "hour").agg(F.array_sort(F.collect_list(entry)).alias("kv"))
    return blocks.select("page_id", "block", "hour", F.map_from_entries(F.transform("kv", lambda s: F.struct(s["k"], s["v"]))).alias("details"))


# W6
def day_rollover(labels: DataFrame, group: str, order: str, label: str = "hour", rows_per_bucket: int = ranking.ROWS_PER_BUCKET) -> DataFrame:
    """Hour labels ('7 am', '11 pm') in order; a pm -> am step starts a new
    day. As in the reference the first label also counts as a step (the
    conditional expression binds as ``(am and last is pm) if pairs else
    'pm'``), so numbering starts at 1.

    A group that holds most rows is split over tasks: steps are summed inside
    segments, and a segment's first label meets the last one before it."""
    rows = ranking.segments(labels, group, order, rows_per_bucket)
    step = lambda at, prev: F.when(prev.isNull(), 1).when(at.contains("am") & prev.contains("pm"), 1).otherwise(0)
    here = Window.partitionBy("_bucket", group).orderBy(order)
    at = rows.withColumn("_n", F.row_number().over(here)).withColumn("_step", F.when(F.col("_n") == 1, 0).otherwise(step(F.col(label), F.lag(label).over(here))))
    at = at.withColumn("_step", F.sum("_step").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    # A segment hands on its last label and its steps; its own first step needs the label before it.
    parts = at.groupBy("_bucket", group).agg(F.min_by(label, "_n").alias("_first"), F.max_by(label, "_n").alias("_last"), F.max("_step").alias("_sum"))
    chain = Window.partitionBy(group).orderBy("_bucket")
    parts = parts.withColumn("_begin", step(F.col("_first"), F.lag("_last").over(chain)))
    off = F.coalesce(F.sum(F.col("_sum") + F.col("_begin")).over(ranking.chained(parts, group)), F.lit(0)) + F.col("_begin")
    out = at.join(parts.select("_bucket", group, off.alias("_off")), ["_bucket", group])
    return out.select(*labels.columns, (F.col("_off") + F.col("_step")).alias("day_offset"))


# X5
def forecast_messages(df: DataFrame, start_date: str, year: int, label: str = "hour",
                      details: str = "details") -> DataFrame:
    """W6 day offsets + 'h am/pm' labels + a given year -> the live weather
    message JSON {date 'yyyy-MM-dd HH:mm:ss', hour, details}, ``details`` an
    object. A 29 February that the given year lacks has a null date, which
    JSON leaves out."""
    day = F.date_add(F.lit(start_date).cast("date"), F.col("day_offset").cast("int"))
    text = F.concat(F.lit(f"{year:04d}-"), F.date_format(day, "MM-dd"), F.lit(" "), F.upper(F.col(label)))
    ts = F.try_to_timestamp(text, F.lit("yyyy-MM-dd h a"))
    return df.select(F.to_json(F.struct(F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("date"),
                                        F.col(label).alias("hour"), F.col(details).alias("details"))).alias("value"))


# W8
def date_spine(keys: DataFrame, key: str, end: str, days: int = 365) -> DataFrame:
    """Each key x each day of the ``days`` days ending at ``end``, inclusive
    (a generator per key row, not a join)."""
    end_d = F.lit(end).cast("date")
    return keys.select(key).distinct().select(
        key, F.explode(F.sequence(F.date_sub(end_d, days), end_d)).alias("date"))
