"""Presentation: alignment text, base pairs, highlights, arc drawings and an HTML report of the best alignments."""

from __future__ import annotations

import html
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns that a report leaves out: whole strings and statistics of the search.
HIDDEN = ("query_sequence", "target_sequence", "query_structure", "target_structure", "alignment_mask", "alignment_content", "trace")
WRAP = 30
#: Bytes of whole strings that are broadcast at most.
WHOLE_BYTES = 64 << 20


def alignment_text(rows: DataFrame) -> DataFrame:
    """query_id, target_id, cluster_id and text, the best alignment of a query first: a heading, the statistics, what is aligned, both rows and the mask between.

    Alignments are numbered within their query; one without strings has no text and no row.
    """
    upper = F.coalesce("aligned_query_structure", "aligned_query_sequence")
    lower = F.coalesce("aligned_target_structure", "aligned_target_sequence")
    number = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "target_id", "cluster_id"))
    line = lambda name, at, text, to: F.concat(F.lit(f"  {name} "), F.lpad(F.col(at).cast("string"), 6, " "), F.lit("  "), text, F.lit("  "), F.lpad(F.col(to).cast("string"), 6, " "))
    text = F.concat_ws(
        "\n",
        F.format_string("Alignment %d: %s vs %s (cluster %d)", number, "query_id", "target_id", "cluster_id"),
        F.format_string("  Score: %.3f\tAvgCosine: %.3f\tLen: %d\tGaps: %d/%d", "score", "avg_cosine", "alignment_length", "gap_opens", "gap_bases"),
        F.concat(F.lit("  Content: "), F.initcap("alignment_content")),  # null, and so left out, where nothing is known
        line("Query ", "query_start", upper, "query_end"),
        F.concat(F.lit(" " * 17), F.when(F.col("alignment_mask") != "", F.col("alignment_mask"))),
        line("Target", "target_start", lower, "target_end"),
        F.lit(""),
    )
    shown = rows.where((F.length(upper) > 0) & (F.length(lower) > 0))
    return shown.select("query_id", "target_id", "cluster_id", text.alias("text"))


def base_pairs(meta: DataFrame, structure: str = "secondary_structure") -> DataFrame:
    """transcript_id, i, j of all base pairs of dot-bracket strings, from 0; brackets without partner pair with nothing.

    A bracket's level is how many pairs are open with it, of which a closing bracket without partner closes none;
    neighbours of one level pair. All of it is running sums in one shuffle by row.
    """
    rows = meta.select("transcript_id", F.coalesce(structure, F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", "transcript_id", F.posexplode(F.split("text", "")).alias("k", "sign")).where("sign IN ('(', ')')")
    by = Window.partitionBy("row").orderBy("k")
    rows = rows.withColumn("sum", F.sum(F.when(F.col("sign") == "(", 1).otherwise(-1)).over(by))
    rows = rows.withColumn("open", F.col("sum") - F.least(F.lit(0), F.min("sum").over(by)))
    rows = rows.withColumn("before", F.lag("open", 1, 0).over(by)).where("sign = '(' OR before > 0")
    level = F.when(F.col("sign") == "(", F.col("open")).otherwise(F.col("before"))
    mates = Window.partitionBy("row", "level").orderBy("k")
    rows = rows.withColumn("level", level).withColumns({"j": F.lead("k").over(mates), "mate": F.lead("sign").over(mates)})
    return rows.where("sign = '(' AND mate = ')'").select("transcript_id", F.col("k").alias("i"), "j")


def as_rna(sequence: Column) -> Column:
    """Upper case with U for T."""
    return F.translate(F.upper(sequence), "T", "U")


def highlights(text: Column) -> Column:
    """Ranges such as "3-7;12" or "[3:7, 12]" as an array of (start, end); list marks and separators , ; | count alike."""
    part = F.filter(F.split(F.regexp_replace(text, r"[\[\]()\s]", ""), "[,;|]"), lambda x: x.rlike(r"^\d+([-:]\d+)?$"))
    return F.transform(part, lambda x: F.struct(F.split(x, "[-:]")[0].cast("int").alias("start"), F.element_at(F.split(x, "[-:]"), -1).cast("int").alias("end")))


#: Names that each side's columns may have, the first that holds something counts; {0} is the side, {1} its number.
ID_NAMES = ("{0}_id", "id{1}")
SEQUENCE_NAMES = ("{0}_sequence", "sequence_{1}", "seq{1}")
STRUCTURE_NAMES = ("{0}_secondary_structure", "{0}_structure", "{0}_rnafold_dotbracket", "secondary_structure_{1}", "structure_{1}", "structure{1}")


def first_filled(rows: DataFrame, names: tuple[str, ...]) -> Column:
    """The first of some columns, of those that are there, that is neither null nor empty."""
    there = [F.when(F.col(n).cast("string") != "", F.col(n).cast("string")) for n in names if n in rows.columns]
    return F.coalesce(*there, F.lit(None).cast("string"))


def whole_numbers(value: Column) -> Column:
    """The whole numbers of a list such as "12,34", "12; 34" or 12; what is none is left out."""
    part = F.transform(F.split(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "[;|]", ","), ","), lambda x: F.trim(x))
    return F.transform(F.filter(part, lambda x: x.rlike(r"^[+-]?\d+$")), lambda x: x.cast("int"))


def ranges_of(starts: Column, ends: Column) -> Column:
    """Pairs of starts and ends by their place in both lists; what has no partner is left out."""
    n = F.least(F.size(starts), F.size(ends))
    return F.transform(F.slice(F.arrays_zip(starts.alias("start"), ends.alias("end")), F.lit(1), n), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def drawing_sides(rows: DataFrame) -> DataFrame:
    """What a structure drawing needs of each side of an alignment: pair, side, transcript_id, sequence, structure, highlights, valid.

    Columns are looked for under several names (``ID_NAMES`` and so on; "subject" may stand for the target); a side
    without structure is unpaired throughout; starts and ends may be lists. Rows are told apart by ``pair``, where it isn't there by a hash of all columns; a side
    without name is named after its pair. Strings of unequal lengths, or none, aren't valid.
    """
    out = None
    rows = rows.withColumn("pair", F.hex(F.xxhash64(*rows.columns))) if "pair" not in rows.columns else rows
    for number, side in ((1, "query"), (2, "target")):
        sides = (side, "subject") if side == "target" else (side,)
        named = lambda names, sides=sides, number=number: tuple(dict.fromkeys(n.format(s, number) for s in sides for n in names))
        sequence = F.coalesce(first_filled(rows, named(SEQUENCE_NAMES)), F.lit(""))
        structure = F.coalesce(first_filled(rows, named(STRUCTURE_NAMES)), F.repeat(F.lit("."), F.length(sequence)))
        ends = [whole_numbers(first_filled(rows, named((f"{{0}}_{e}", f"{e}_{{1}}", f"{e}{{1}}")))) for e in ("start", "end")]
        one = rows.select(
            "pair", F.lit(side).alias("side"), F.coalesce(first_filled(rows, named(ID_NAMES)), F.format_string(f"RNA_%s_{number}", F.col("pair").cast("string"))).alias("transcript_id"),
            F.translate(sequence, "Tt", "Uu").alias("sequence"), structure.alias("structure"), ranges_of(*ends).alias("highlights"),
            ((F.length(sequence) == F.length(structure)) & (F.length(sequence) > 0)).alias("valid"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def drawings(sides: DataFrame) -> DataFrame:
    """pair, side, transcript_id, width, arcs and svg of the valid sides of ``drawing_sides``: an arc for each base pair, those inside a highlight marked.

    A drawing is as wide as its structure is long, from 100 to 700. Base pairs are worked out once a distinct structure,
    told by its SHA-256; a drawing is then made of them where its row is, so no task holds the paths of several drawings.
    """
    valid = sides.where("valid").dropDuplicates(["pair", "side"]).withColumn("of", F.sha2("structure", 256))
    shapes = sides.where("valid").groupBy(F.sha2("structure", 256).alias("transcript_id")).agg(F.first("structure").alias("structure"))
    arcs = base_pairs(shapes, "structure").groupBy(F.col("transcript_id").alias("of")).agg(F.sort_array(F.collect_list(F.struct("i", "j"))).alias("arcs"))
    width = F.greatest(F.lit(100), F.least(F.lit(700), F.length("structure")))
    valid = valid.select("of", "pair", "side", "transcript_id", "highlights", F.length("structure").alias("n"), width.alias("width"))
    x = lambda k: F.format_string("%.2f", (k + F.lit(0.5)) * F.col("width") / F.col("n"))
    inside = lambda a: F.exists("highlights", lambda h: (h["start"] <= a["i"]) & (a["j"] < h["end"]))
    radius = lambda a: F.format_string("%.2f", (a["j"] - a["i"]) * F.col("width") / F.col("n") / 2)
    floor = F.floor(F.col("width") / 2).cast("string")
    path = lambda a: F.concat(F.lit('<path d="M '), x(a["i"]), F.lit(" "), floor, F.lit(" A "), radius(a), F.lit(" "), radius(a), F.lit(" 0 0 1 "), x(a["j"]), F.lit(" "), floor, F.lit('" fill="none" stroke="'), F.when(inside(a), "#c0392b").otherwise("#95a5a6"), F.lit('"/>'))
    full = valid.join(arcs, "of", "left").withColumn("arcs", F.coalesce("arcs", F.array().cast("array<struct<i:int,j:int>>")))
    bar = lambda a, b, more: F.concat(F.lit('<line x1="'), a, F.lit('" y1="'), floor, F.lit('" x2="'), b, F.lit('" y2="'), floor, F.lit(f'" {more}/>'))
    edge = lambda k: F.format_string("%.2f", k * F.col("width") / F.col("n"))
    marks = F.array_join(F.transform("highlights", lambda h: bar(edge(h["start"]), edge(h["end"]), 'stroke="#c0392b" stroke-width="4"')), "")
    head = F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg" width="'), F.col("width").cast("string"), F.lit('" height="'), (F.floor(F.col("width") / 2) + 6).cast("string"), F.lit('">'))
    svg = F.concat(head, F.array_join(F.transform("arcs", path), ""), bar(F.lit("0"), F.col("width").cast("string"), 'stroke="#333"'), marks, F.lit("</svg>"))
    return full.select("pair", "side", "transcript_id", "width", F.size("arcs").alias("arcs"), svg.alias("svg"))


def with_drawings(rows: DataFrame) -> DataFrame:
    """Alignments with the drawings of both sides inline: query_drawing and target_drawing hold an image's data address, null where there is none."""
    rows = rows.withColumn("pair", F.concat_ws(":", "query_id", "target_id", F.col("cluster_id").cast("string")))
    image = F.concat(F.lit("data:image/svg+xml;base64,"), F.base64(F.col("svg").cast("binary")))
    made = drawings(drawing_sides(rows)).select("pair", "side", image.alias("image")).groupBy("pair").pivot("side", ["query", "target"]).agg(F.first("image"))
    return rows.join(made.select("pair", *[F.col(s).alias(f"{s}_drawing") for s in ("query", "target")]), "pair", "left").drop("pair")


def broken(rows: DataFrame) -> DataFrame:
    """Long strings broken for HTML."""
    for c, t in rows.dtypes:
        if t == "string" and re.search("sequence|structure", c):
            rows = rows.withColumn(c, F.rtrim(F.regexp_replace(c, f"(.{{{WRAP}}})(?=.)", "$1<br>")))
    return rows


def report_rows(rows: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Without the hidden columns, scores rounded to one place, long strings broken for HTML, the best first.

    whole: columns that follow from target_id, once an id, such as whole strings. They are joined to the rows when these
    are in order, so they are neither sorted nor shuffled with each row; beyond ``WHOLE_BYTES`` they are joined before.
    """
    kept = [c for c in rows.columns if c not in HIDDEN]
    out, order = rows.select(*kept).withColumn("score", F.round("score", 1)), (F.desc("score"), "query_id", "target_id", "cluster_id")
    if whole is None:
        return broken(out).orderBy(*order)
    whole = broken(whole)
    names = [*kept, *(c for c in whole.columns if c != "target_id")]
    held = whole.agg(sum((F.coalesce(F.sum(F.octet_length(F.col(c).cast("string"))), F.lit(0)) for c in whole.columns), F.lit(0))).first()[0]
    if held > WHOLE_BYTES:
        return broken(out).join(whole, "target_id", "left").select(*names).orderBy(*order)
    # a broadcast leaves the order, which would be dropped as of no use to a join but for a place that is asked for
    place = "_".join(["place", *names])
    ranked = broken(out).orderBy(*order).withColumn(place, F.monotonically_increasing_id()).where(F.col(place) >= 0).drop(place)
    return ranked.join(F.broadcast(whole), "target_id", "left").select(*names)


def report_html(rows: DataFrame, most: int, title: str = "Alignments") -> str:
    """A page of the best alignments, with the drawings of those that have some (``with_drawings``)."""
    pictures = [c for c in ("query_drawing", "target_drawing") if c in rows.columns]
    got = report_rows(rows).limit(most).collect()
    names = [c for c in (got[0].asDict() if got else ()) if c not in pictures]
    head = "".join(f"<th>{html.escape(n)}</th>" for n in names)
    safe = lambda v: html.escape("" if v is None else str(v)).replace("&lt;br&gt;", "<br>")
    body = []
    for r in got:
        images = "".join(f'<img src="{r[c]}" alt="{safe(r["query_id" if c.startswith("query") else "target_id"])}"/>' for c in pictures if r[c])
        body.append(f"<tr>{''.join(f'<td>{safe(r[n])}</td>' for n in names)}</tr>" + (f'<tr><td colspan="{len(names)}">{images}</td></tr>' if images else ""))
    return f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1><table border='1'><tr>{head}</tr>{''.join(body)}</table></body></html>"
