"""Web archives: pages written as WARC records, and archives read back by verified chains.

Writing needs no code per row: a record is a text, and records end in two line breaks, which is
what the text writer puts after each row.

Reading splits files wherever the text reader does, at the magic that begins a record. A payload
may hold the magic too, so each such place is only a candidate. A task states for every candidate
where its successor must begin, by the candidate's own content length. The file start is a record;
pointer jumping, which doubles the distance covered in every round, marks the candidates reachable
from it. What is not reachable lies inside a payload and is put back into it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from headgate.llm.tables import dropped, kept, removed
from headgate.session import workspace

#: The parts of a record.
BREAK = "\r\n"
MAGIC = "WARC/1.1" + BREAK
END = BREAK + BREAK
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What is made of a record's payload.
Wanted = Callable[[Column], list[Column]]
BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary value: five hexadecimal digits are four of these."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), *BASE32)


def plan_records(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`uid, page_id, url, html, digest, kind, of` per page, and the table that it reads.

    `of` is the record that a revisit refers to.

    Of pages with equal payloads (null is empty) that with the smallest `page_id` is the response;
    a null id comes last, of repeated ids one row is taken.
    """
    html = F.coalesce("html", F.lit(""))
    named = pages.select(F.monotonically_increasing_id().alias("uid"), "page_id", F.col("url").cast("string").alias("url"), html.alias("html"))
    named = kept(named.withColumn("digest", base32_sha1(F.encode("html", "UTF-8"))), "op2-pages")
    first = F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "uid")).alias("first")
    narrow = named.select("uid", "page_id", "digest", F.octet_length("html").alias("size"))
    copied = narrow.groupBy("digest", "size").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    # Only the copies are told apart; the payloads themselves need not move for it.
    again = narrow.join(copied, ["digest", "size"]).where("uid <> first.uid").select("uid", F.col("first.uid").alias("of"))
    joined = named.join(kept(again, "op2-again"), "uid", "left")
    kind = F.when(F.col("of").isNull(), "response").otherwise("revisit")
    return joined.select("uid", "page_id", "url", "html", "digest", kind.alias("kind"), "of"), named


def _field(name: str, value: Column) -> Column:
    """A header line, none for a null value; a value cannot break the line."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]", " "), F.lit(BREAK)))


def write_warc(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write the archives of `pages` (`page_id, url, html`) below `path`, one file per partition.

    A compressed file is read by one task, so it should be no larger than a partition; with
    `compression` none, readers may split it anywhere.
    """
    plan, named = plan_records(pages)
    response = F.col("kind") == "response"
    body = F.when(response, F.col("html")).otherwise("")
    uri = F.concat(F.lit("<urn:x-page:"), F.col("uid").cast("string"), F.lit(">"))
    refers = F.when(~response, F.concat(F.lit("<urn:x-page:"), F.col("of").cast("string"), F.lit(">")))
    record = F.concat(
        F.lit(MAGIC), _field("WARC-Type", F.col("kind")), _field("WARC-Record-ID", uri),
        F.lit(f"WARC-Date: 1970-01-01T00:00:00Z{BREAK}"), _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), _field("WARC-Refers-To", refers),
        _field("WARC-Profile", F.when(~response, PROFILE)), _field("X-Page-Id", F.col("page_id").cast("string")),
        _field("Content-Length", F.octet_length(body).cast("string")), F.lit(BREAK), body,
    )
    plan.select(record.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)
    dropped(named)


def _header(head: Column, name: str) -> Column:
    value = F.regexp_extract(F.concat(F.lit(BREAK), head), rf"\r\n(?i:{name}): *([^\r\n]*)", 1)
    return F.when(value != "", value)


def _content(all_: Column, head: Column, size: Column, wanted: Wanted) -> list[Column]:
    """The fields of a record, given from its header on, with the lengths of header and payload."""
    text = F.substring(all_, F.lit(1), head.cast("int")).cast("string")
    payload = F.substring(all_, (head + len(END) + 1).cast("int"), size.cast("int"))
    names = {"kind": "WARC-Type", "record_id": "WARC-Record-ID", "refers_id": "WARC-Refers-To", "page_id": "X-Page-Id", "digest": "WARC-Payload-Digest"}
    return [_header(text, header).alias(name) for name, header in names.items()] + wanted(payload)


def _candidates(spark: SparkSession, path: str, wanted: Wanted | None) -> tuple[DataFrame, DataFrame]:
    """`file, block, seq, at, bytes, head, size, next, content` of what stands between two magics, and a table of the pieces.

    `at` is the offset of the magic, `bytes` the length of the piece after it, `next` where the
    following record must begin. `content` is the record's, where the piece would hold all of it.
    """
    lines = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("raw"),
    )
    lines = kept(lines, "op2-lines")
    here = Window.partitionBy("file", "block")
    before = here.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    step = F.octet_length("raw") + F.lit(len(MAGIC)).cast("long")
    # Where a block's first piece begins: the pieces of the blocks before it, a few numbers per block.
    sizes = lines.groupBy("file", "block").agg(F.sum(step).alias("bytes"))
    shift = F.coalesce(F.sum("bytes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("file", "block", shift.alias("shift"))
    head = F.substring_index(F.col("raw").cast("string"), END, 1)
    size = F.expr("try_cast(nullif(size, '') AS bigint)")
    narrow = lines.withColumn("head", F.octet_length(head).cast("long")).withColumn("size", F.regexp_extract(F.concat(F.lit(BREAK), head), r"\r\n(?i:content-length): *([0-9]{1,18})", 1)).withColumn("size", size)
    content = F.lit(None).cast("int")
    if wanted:
        content = F.when(F.octet_length("raw") >= F.col("head") + len(END) + F.col("size"), F.struct(*_content(F.col("raw"), F.col("head"), F.col("size"), wanted)))
    narrow = kept(narrow.select("file", "block", "seq", step.alias("step"), "head", "size", content.alias("content")), "op2-narrow")
    placed = narrow.withColumn("inside", F.coalesce(F.sum("step").over(before), F.lit(0))).join(starts, ["file", "block"])
    at = F.col("shift") + F.col("inside") - len(MAGIC)
    end = F.col("at") + len(MAGIC) + F.col("head") + len(END) + F.col("size") + len(END)
    found = placed.withColumn("at", at).withColumn("next", end)
    bytes_ = (F.col("step") - len(MAGIC)).alias("bytes")
    found = kept(found.select("file", "block", "seq", "at", bytes_, "head", "size", "next", "content"), "op2-candidates")
    dropped(narrow)
    return found, lines


def reachable(links: DataFrame) -> DataFrame:
    """`file, at` of the records: candidates reachable from the start of their file.

    `links` has `file, at, next`. After k rounds a pointer leads 2^k records on, and all records
    nearer than that are marked. Offsets only grow, so there are no cycles.
    """
    jump = kept(links.where("next IS NOT NULL").select("file", "at", F.col("next").alias("to")), "op2-jump")
    marked = kept(links.where("at = 0").select("file", "at"), "op2-marked")
    ends = links.select("file", F.col("at").alias("to"))
    jump = kept(jump.join(ends, ["file", "to"], "left_semi"), "op2-jump")  # a pointer to no candidate leads nowhere
    while not jump.isEmpty():
        more = marked.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        both = kept(marked.union(more), "op2-marked")
        onward = jump.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        doubled = kept(jump.join(onward, ["file", "to"]).select("file", "at", F.col("far").alias("to")), "op2-jump")
        dropped(marked)
        dropped(jump)
        marked, jump = both, doubled
    return marked


def read_warc(spark: SparkSession, path: str, wanted: Wanted | None = None) -> DataFrame:
    """`file, at, kind, record_id, refers_id, page_id, digest, payload` of every record below `path`.

    With `wanted`, what it makes of a payload stands in the payload's place, and is computed where
    the payload is read, so that no payload that lies in one piece has to move. Files may be split
    anywhere. A file that does not begin with a record has none; a record whose end is not followed
    by a record or the end of the file is kept, and what follows it is dropped.
    """
    links, lines = _candidates(spark, path, wanted)
    links = links.where("at >= 0")  # what stands before the first magic is not a candidate
    real = reachable(links.select("file", "at", "next"))
    marked = links.join(real.withColumn("real", F.lit(True)), ["file", "at"], "left")
    # The record a piece belongs to is the last real one at or before it, here or in an earlier block.
    own = F.when(F.col("real"), F.struct("at", "head", "size"))
    block = Window.partitionBy("file", "block").orderBy("at")
    last = marked.groupBy("file", "block").agg(F.max(own).alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "block", F.max("last").over(earlier).alias("carried"))
    owned = marked.withColumn("here", F.max(own).over(block)).join(carried, ["file", "block"])
    owner = F.coalesce("here", "carried").alias("owner")
    owned = owned.select("file", "block", "seq", "at", "bytes", "content", owner).where("owner IS NOT NULL")
    inside = F.col("at") < F.col("owner.at") + len(MAGIC) + F.col("owner.head") + len(END) + F.col("owner.size")
    # Nearly every record lies in one piece; only those with the magic inside are put together.
    alone = (F.col("at") == F.col("owner.at")) & (F.col("bytes") >= F.col("owner.head") + len(END) + F.col("owner.size"))
    owned = kept(owned.where(inside).select("file", "block", "seq", "at", "content", "owner", alone.alias("alone")), "op2-owned")
    keys = ["file", "block", "seq"]
    # Known by its size, so that it is the small side of the join with all pieces wherever it is small.
    broken = kept(owned.where("NOT alone").select(*keys, "at", "owner"), "op2-broken")
    whole = broken.join(lines, keys).groupBy("file", F.col("owner.at").alias("at"), F.col("owner.head").alias("head"), F.col("owner.size").alias("size")).agg(
        F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("parts")
    )
    joined = F.expr(f"aggregate(slice(parts, 2, size(parts)), parts[0].raw, (all, p) -> concat(all, encode('{MAGIC[:-2]}\\r\\n', 'UTF-8'), p.raw))")
    whole = whole.select("file", "at", "head", "size", joined.alias("all"))
    content = _content(F.col("all"), F.col("head"), F.col("size"), wanted or (lambda payload: [payload.alias("payload")]))
    if wanted:
        single = owned.where("alone").select("file", "at", "content.*")
        return single.union(whole.select("file", "at", *content))
    single = owned.where("alone").join(lines, keys).select("file", owned["at"], F.col("owner.head").alias("head"), F.col("owner.size").alias("size"), F.col("raw").alias("all"))
    return single.union(whole).select("file", "at", *content)


def archived(pages: DataFrame, compression: str = "gzip") -> DataFrame:
    """`page_id, payload_bytes, payload_digest, record_type, refers_to` of pages written and read back.

    Size and digest are taken from the payload that was read, for a revisit from that of the
    response it refers to. Null html is an empty payload; repeated rows and rows with null ids have
    records of their own. Other columns are left unread; an empty table gives no rows.
    """
    spark = pages.sparkSession
    path = workspace(spark, "op2-warc")
    write_warc(pages, path, compression)
    found = read_warc(spark, path, lambda payload: [F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest")])
    removed(spark, path)  # read: what follows uses the pieces, not the files
    kind = pages.schema["page_id"].dataType
    found = kept(found.select(F.col("page_id").cast(kind).alias("page_id"), "kind", "record_id", "refers_id", "payload_bytes", "payload_digest"), "op2-found")
    responses = found.where("kind = 'response'")
    full = responses.select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
    again = found.where("kind = 'revisit'").join(full, "refers_id")
    first = responses.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.lit(None).cast(kind).alias("refers_to"))
    return first.union(again.select("page_id", "b", "d", "kind", "refers_to"))
