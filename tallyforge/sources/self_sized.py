"""Records whose own first bytes or lines say how long they are: frames in byte streams, epochs in observation files.

Where a record begins follows from all those before it, so starts are found block by block and between blocks by pointer
jumping (``operators.fixpoints``); no file or stream has to be read from front to back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.operators.fixpoints import BLOCK, block_of, followed, self_sized
from tallyforge.session import Scratch


def number(data: Column, *, little: bool = False) -> Column:
    """The unsigned whole number that up to seven bytes spell, the great end first unless ``little``."""
    digits = F.hex(data)
    if little:
        digits = F.array_join(F.reverse(F.filter(F.split(F.regexp_replace(digits, "(..)", "$1 "), " "), lambda x: x != "")), "")
    return F.conv(digits, 16, 10).cast("bigint")


def byte_at(data: Column, at: int, n: int) -> Column:
    return F.substring(data, at + 1, n)


def frames(packets: DataFrame, keys: list[str], order: str, payload: str, *, header: int, size: Callable[[Column], Column], heads: bool = True) -> DataFrame:
    """keys, place, size, record, state, head of the frames in streams of packets.

    The payloads of a key's packets, in the order of ``order``, are one stream of bytes, and frames run across packets.
    ``size`` tells from a frame's first ``header`` bytes how many bytes it has in all, or null where these bytes begin none; it
    is asked at every byte, with the bytes of later packets at hand. ``head`` is those bytes; it is left out without ``heads``. A stream's last row may be
    ``truncated`` or ``malformed``, as in ``self_sized``; fewer than ``header`` bytes at a stream's end begin no frame. Null and empty
    payloads are passed over, rows with a null key or order are left out.
    """
    given = packets.where(F.col(payload).isNotNull() & (F.length(payload) > 0) & F.col(order).isNotNull())
    given = given.select(*keys, F.col(order).alias("_o"), F.col(payload).alias("_d"))
    w = W.partitionBy(*keys).orderBy("_o")
    before = F.coalesce(F.sum(F.length("_d")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    given = given.withColumn("_at", before)
    ahead = W.partitionBy(*keys).orderBy("_at")
    some = F.collect_list(F.substring("_d", 1, header)).over(ahead.rangeBetween(0, max(0, header - 2)))
    nothing = F.lit(b"")
    begins = given.withColumn("_h", F.aggregate(some, nothing, lambda a, x: F.concat(a, x)))
    held = begins.withColumn("_all", F.concat("_d", F.coalesce(F.substring(F.lead("_h").over(ahead), 1, max(0, header - 1)), nothing)))
    # a packet's part of each block, and the header's rest that may lie behind the part; a block's parts are one run of bytes
    end = F.col("_at") + F.length("_d")
    parts = held.select(*keys, "_at", "_all", end.alias("_end"), F.explode(F.sequence(block_of("_at", BLOCK), F.expr(f"(_at + length(_d) - 1) div {BLOCK}"))).alias("_b"))
    parts = parts.withColumns({"_from": F.greatest("_at", F.col("_b") * BLOCK), "_to": F.least("_end", (F.col("_b") + 1) * BLOCK)})
    cut = lambda a, n: F.substr("_all", (F.col(a) - F.col("_at") + 1).cast("int"), n)
    parts = parts.select(*keys, "_b", "_from", "_to", cut("_from", (F.col("_to") - F.col("_from")).cast("int")).alias("_d"), cut("_to", F.lit(max(0, header - 1))).alias("_x"))
    joined = parts.groupBy(*keys, "_b").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.expr("listagg(_d) within group (order by _from)").alias("_d"), F.max_by("_x", "_from").alias("_x"))
    runs = Scratch(packets.sparkSession, "frames").keep(joined.select(*keys, "_b", "_from", (F.col("_to") - F.col("_from")).cast("int").alias("_m"), F.concat("_d", "_x").alias("_d")), "runs")
    head = lambda i: F.substr("_d", i + 1, F.lit(header))
    sizes = F.transform(F.sequence(F.lit(0), F.col("_m") - 1), lambda i: F.coalesce(F.when(F.length(head(i)) == header, size(head(i))), F.lit(0)).cast("bigint"))
    first = F.expr(f"_from % {BLOCK}").cast("int")
    found = followed(runs.select(*keys, "_b", first.alias("_low"), sizes.alias("_n")), keys, "place", BLOCK)
    if not heads:
        return found
    marked = found.withColumn("_b", block_of("place", BLOCK)).join(runs, [*keys, "_b"], "left")
    own = F.when(F.col("size").isNotNull(), head((F.col("place") - F.col("_from")).cast("int")))
    return marked.select(*keys, "place", "size", "record", "state", own.alias("head"))


def industrial_size(head: Column) -> Column:
    """The size of a request or reply of the common industrial protocol over TCP: transaction, 0, length of what follows, unit."""
    length = number(byte_at(head, 4, 2))
    return F.when((number(byte_at(head, 2, 2)) == 0) & length.between(2, 254), length + 6)


def datagram_size(kinds: list[str], most: int) -> Callable[[Column], Column]:
    """The size of a datagram that has its length before and after it, then four letters for its kind."""

    def size(head: Column) -> Column:
        length = number(byte_at(head, 0, 4), little=True)
        return F.when(F.decode(byte_at(head, 4, 4), "ISO-8859-1").isin(kinds) & length.between(4, most), length + 8)

    return size


#: Characters of an observation line: five fields of sixteen, fourteen of which are the number; satellites on an epoch's line.
FIELDS, WIDTH, DIGITS, SATELLITES = 5, 16, 14, 12


def epochs(lines: DataFrame, types: int) -> DataFrame:
    """path, line, size, record, state, flag, satellites of the records of observation files, from behind their header on.

    lines: path, line, value, with blank ones. An epoch's line has a flag and a count: of satellites, each with as many lines as
    ``types`` numbers take, and the names of twelve satellites a line; or, for flags 2 to 5, of comment lines that follow. A blank
    line is passed over. Another flag is malformed.
    """
    count = F.substring("value", 30, 3).try_cast("int")
    flag = F.substring("value", 29, 1).try_cast("int")
    more = F.greatest(F.lit(0), F.ceil(count / SATELLITES).cast("int") - 1)
    size = (
        F.when(F.trim("value") == "", 1)
        .when(flag.between(2, 5), count + 1)
        .when(flag.isin(0, 1, 6), 1 + more + count * -(-types // FIELDS))
    )
    facts = lines.withColumns({"_size": size, "flag": flag, "satellites": count, "_blank": F.trim("value") == ""})
    found = self_sized(facts, ["path"], "line", F.col("_size"))
    marked = found.join(facts.select("path", "line", "flag", "satellites", "_blank"), ["path", "line"], "left")
    return marked.where(~F.coalesce("_blank", F.lit(False))).drop("_blank")


def observations(lines: DataFrame, codes: list[str]) -> DataFrame:
    """path, record, satellite (its place in the epoch), code, value of every number of the whole epochs; blank fields are left out, others that are no number are null."""
    per = -(-len(codes) // FIELDS)
    found = epochs(lines, len(codes)).where("state = 'whole' and flag in (0, 1) and satellites > 0")
    more = F.greatest(F.lit(0), F.ceil(F.col("satellites") / SATELLITES).cast("int") - 1)
    each = found.select("path", "record", F.col("line").alias("_first"), more.alias("_more"), F.explode(F.sequence(F.lit(0), F.col("satellites") - 1)).alias("satellite"))
    each = each.select("path", "record", "satellite", "_first", "_more", F.explode(F.sequence(F.lit(0), F.lit(per - 1))).alias("_k"))
    placed = each.select("path", "record", "satellite", "_k", (F.col("_first") + 1 + F.col("_more") + F.col("satellite") * per + F.col("_k")).alias("line"))
    texts = placed.join(lines.select("path", "line", "value"), ["path", "line"])
    names = F.array(*map(F.lit, codes))
    fields = texts.select("path", "record", "satellite", "value", F.explode(F.sequence(F.lit(0), F.lit(FIELDS - 1))).alias("_f"), "_k")
    text = F.trim(F.substr("value", F.col("_f") * WIDTH + 1, F.lit(DIGITS)))
    out = fields.select("path", "record", "satellite", F.get(names, F.col("_k") * FIELDS + F.col("_f")).alias("code"), text.alias("_t"))
    return out.where("code is not null and _t <> ''").select("path", "record", "satellite", "code", F.col("_t").try_cast("double").alias("value"))
