"""Case timelines: ordered event text per case.

A case is one row, unless its text exceeds `part_bytes`: no cell could hold the text of a case of any
size. Such a case comes as `partes` rows numbered by `parte`, each with the counts of the whole case
and, in `piezas_antes`, the number of pieces in its earlier parts; joining the parts in order with the
separator is the whole timeline. Requests, pieces and audits of the parts are those of one case again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselog.functions import dates as dt
from caselog.functions import text as tx
from caselog.operators import notes as nt
from caselog.operators import skew
from caselog.session import cut_lineage

SEPARATOR = " | "
#: Text of a part; a part may exceed it by one chunk of 2**TEXT_CHUNK_BITS events.
PART_BYTES = 1 << 26
#: Above so many events a case is put in order chunk by chunk instead of by one task.
TASK_EVENTS = 50_000
TEXT_CHUNK_BITS = 10
CASE_KEY = ["numero_siniestro", "placa"]
DESCRIPTORS = ["nit_taller", "nombre_taller", "numero_aviso", "usuario", "rol_analista"]


def _joined(order: list[str], text: str, separator: str) -> Column:
    """Non-null texts in order. Null order values sort first."""
    items = F.collect_list(F.when(F.col(text).isNotNull(), F.struct(*order, text)))
    return F.array_join(F.transform(F.sort_array(items), lambda e: e[text]), separator)


def big_cases(events: DataFrame, keys: list[str], text: str, part_bytes: int) -> skew.Heavy:
    """Keys with too many events for one task or too much text for one part."""
    return skew.heavy_keys(events, keys, TASK_EVENTS, F.octet_length(text), part_bytes)


def timeline_parts(
    events: DataFrame,
    keys: list[str],
    order: list[str],
    text: str = "evento",
    separator: str = SEPARATOR,
    part_bytes: int = PART_BYTES,
    heavy: skew.Heavy | None = None,
) -> DataFrame:
    """keys, parte, partes, piezas_antes, total (non-null texts of the key), texto.

    Texts of big keys are joined per chunk of the order and attached to their part by (key, chunk);
    windows over a key see one slim row per chunk. A part without any text only stands for a key
    without any.
    """
    slim = events.select(*keys, *order, text)
    heavy = heavy or big_cases(slim, keys, text, part_bytes)
    normal, hot = skew.split_heavy(slim, keys, heavy)
    result = None
    if normal is not None:
        whole = normal.groupBy(*keys).agg(F.count(text).alias("total"), _joined(order, text, separator).alias("texto"))
        one = [F.lit(n).cast("long").alias(c) for c, n in (("parte", 0), ("partes", 1), ("piezas_antes", 0))]
        result = whole.select(*keys, *one, "total", "texto")
    if hot is not None:
        ranked = skew.ordered_chunks(hot, keys + order, TEXT_CHUNK_BITS)
        parts = _joined_parts(_text_chunks(ranked, keys, text, separator), keys, separator, part_bytes)
        result = parts if result is None else result.unionByName(parts)
    return result


PART_COLUMNS = ["parte", "partes", "piezas_antes", "total"]


def _text_chunks(
    ranked: DataFrame, keys: list[str], text: str, separator: str, first: list[str] = ()
) -> DataFrame:
    """Per key and chunk: _rows, _events, _bytes, texto and, where `first` is asked for, its least values as a struct."""
    return cut_lineage(
        ranked.groupBy(*keys, "_chunk").agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count(text).alias("_events"),
            F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("_bytes"),
            *([F.min(F.struct(*first)).alias("_first")] if first else []),
            _joined(["_rank"], text, separator).alias("texto"),
        )
    )


def _joined_parts(chunks: DataFrame, keys: list[str], separator: str, part_bytes: int) -> DataFrame:
    """The chunks of each key joined to parts: keys, parte, partes, piezas_antes, total, texto."""
    pieces = F.when(F.col("_events") > 0, F.size(F.split("texto", r"\|"))).otherwise(F.lit(0)).alias("_pieces")
    placed = _parts_of(chunks.select(*keys, "_chunk", "_events", "_bytes", pieces), keys, part_bytes)
    named = placed.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_chunk").alias("_at"), *PART_COLUMNS)
    same = F.col("_chunk") == F.col("_at")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return chunks.join(named, same).groupBy(*keys, "parte").agg(
        F.first("partes").alias("partes"),
        F.min("piezas_antes").alias("piezas_antes"),
        F.first("total").alias("total"),
        _joined(["_chunk"], "texto", separator).alias("texto"),
    )


def _parts_of(chunks: DataFrame, keys: list[str], part_bytes: int) -> DataFrame:
    """The part of each chunk that has text, or of one chunk of a key that has none."""
    key = Window.partitionBy(*keys)
    along = key.orderBy("_chunk")
    before = F.sum("_bytes").over(along) - F.col("_bytes")
    counted = chunks.withColumns(
        {
            "total": F.sum("_events").over(key),
            "piezas_antes": F.sum("_pieces").over(along) - F.col("_pieces"),
            "_step": F.floor(before / F.lit(part_bytes)),
            "_number": F.row_number().over(along),
        }
    )
    kept = counted.where((F.col("_events") > 0) | ((F.col("total") == 0) & (F.col("_number") == 1)))
    numbered = kept.withColumn("parte", (F.dense_rank().over(key.orderBy("_step")) - 1).cast("long"))
    return numbered.withColumn("partes", F.max("parte").over(key) + 1)


def note_events(notes: DataFrame, ordinal: str) -> DataFrame:
    """Canonical, cleaned notes with their event text; `ordinal` breaks ties of date."""
    return nt.event_columns(nt.clean_cells(nt.canonical_columns(notes, keep=[ordinal])))


def unify_cases(
    notes: DataFrame,
    ordinal: str,
    separator: str = SEPARATOR,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """One row per case, or per part of its text, with first descriptors, counts and timeline.

    Notes of big cases are put in order by their cleaned key and date. The other cells cross uncleaned,
    as Spark computes rows twice to order them; they are cleaned once after, and the chunks hold text,
    descriptors and counts alike.
    """
    events = note_events(notes, ordinal)
    order = ["fecha_dt", "fecha_obs_norm", ordinal]
    heavy = big_cases(events, CASE_KEY, "evento", part_bytes)
    first = F.min(F.struct(*order, *DESCRIPTORS)).alias("_first")
    counts = [
        F.count(F.lit(1)).alias("total_eventos"),
        F.count("evento").alias("eventos_no_vacios"),
    ]
    shape = [
        *[F.col(f"_first.{c}").alias(c) for c in DESCRIPTORS[:3]],
        *CASE_KEY,
        *[F.col(f"_first.{c}").alias(c) for c in DESCRIPTORS[3:]],
        "total_eventos",
        "eventos_no_vacios",
        *PART_COLUMNS[:3],
        F.col("texto").alias("observaciones_unidas"),
    ]
    normal, _ = skew.split_heavy(events, CASE_KEY, heavy)
    placed = [*CASE_KEY, "fecha_observacion"]
    dated = nt.date_columns(nt.clean_cells(nt.canonical_columns(notes, keep=[ordinal]), placed))
    _, hot = skew.split_heavy(dated, CASE_KEY, heavy)
    result = None
    if normal is not None:
        cases = normal.groupBy(*CASE_KEY).agg(
            first, *counts, _joined(order, "evento", separator).alias("texto")
        )
        one = {c: F.lit(n).cast("long") for c, n in zip(PART_COLUMNS[:3], (0, 1, 0))}
        result = cases.withColumns(one).select(*shape)
    if hot is not None:
        ranked = skew.ordered_chunks(hot.drop("fecha_observacion"), CASE_KEY + order, TEXT_CHUNK_BITS)
        cleaned = nt.event_text(nt.clean_cells(ranked, [c for c in nt.CLEANED if c not in placed]))
        chunks = _text_chunks(cleaned, CASE_KEY, "evento", separator, [*order, *DESCRIPTORS])
        heads = chunks.groupBy(*CASE_KEY).agg(
            F.min("_first").alias("_first"),
            F.sum("_rows").alias("total_eventos"),
            F.sum("_events").alias("eventos_no_vacios"),
        )
        parts = _joined_parts(chunks, CASE_KEY, separator, part_bytes)
        few = F.broadcast(heads) if heavy.listed else heads
        giant = parts.join(few, CASE_KEY).select(*shape)
        result = giant if result is None else result.unionByName(giant)
    return result


def count_pieces(joined: Column) -> Column:
    """Non-blank pieces of a bar-separated text."""
    pieces = F.split(F.coalesce(joined, F.lit("")), r"\|")
    return F.size(F.filter(pieces, lambda p: ~tx.is_blank(p)))


#: The number 0 as text.
ZERO = r"^[+-]?0+([.]0*)?$"


def _key_of(cell: Column, skip_zero: bool) -> Column:
    key = tx.null_if_blank(tx.first_of_list(cell))
    return F.when(~key.rlike(ZERO), key) if skip_zero else key


def case_links(notes: DataFrame, ordinal: str, skip_zero: bool = False) -> DataFrame:
    """Each note with the key that names its case: aviso, else siniestro, else placa, else itself.

    With `skip_zero` the number 0 names no case, as in sources where it stands for a missing number.
    """
    named = {"aviso": "numero_aviso", "siniestro": "numero_siniestro", "placa": "placa"}
    read = notes.select(
        ordinal,
        "fecha_observacion",
        "observacion",
        *[_key_of(F.col(c), skip_zero).alias(f"_{kind}") for kind, c in named.items()],
    )
    kind = F.coalesce(*[F.when(F.col(f"_{k}").isNotNull(), F.lit(k)) for k in named], F.lit("fila"))
    key = F.coalesce(*[F.col(f"_{k}") for k in named], F.col(ordinal).cast("string"))
    every = [F.struct(F.lit(k).alias("tipo"), F.col(f"_{k}").alias("clave")) for k in named]
    alone = F.struct(F.lit("fila").alias("tipo"), F.when(kind == "fila", key).alias("clave"))
    return read.select(
        ordinal,
        "fecha_observacion",
        "observacion",
        F.array(*every, alone).alias("_all"),
        kind.alias("tipo"),
        key.alias("clave"),
    )


def linked_timelines(
    notes: DataFrame,
    ordinal: str,
    parsed_dates: bool = True,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Timeline of every key some note chose: tipo, clave, notas (choosers), total, parte, partes, texto.

    The timeline of a key gathers all notes carrying it, not only those that chose it. Notes find
    their timeline through `case_links`; the text is stored once per key, never once per note.
    """
    links = case_links(notes, ordinal)
    chosen = links.groupBy("tipo", "clave").agg(F.count(F.lit(1)).alias("notas"))
    date = dt.audit_date(F.col("fecha_observacion")) if parsed_dates else F.nullif(
        F.col("fecha_observacion").cast("string"), F.lit("")
    )
    pieces = links.withColumn("fecha", F.coalesce(date, F.lit(dt.NO_DATE)))
    pieces = pieces.withColumn("nota", tx.pipe_safe(F.col("observacion")))
    line = F.regexp_replace(F.concat_ws(" - ", "fecha", "nota"), "^[ -]+|[ -]+$", "")
    pieces = pieces.withColumn("evento", F.when(F.col("nota") != "", line))
    members = pieces.select("fecha", ordinal, "evento", F.explode("_all").alias("_k"))
    members = members.select("_k.*", "fecha", ordinal, "evento").where(F.col("clave").isNotNull())
    key = ["tipo", "clave"]
    wanted = _worth_gathering(members, chosen, key)
    parts = timeline_parts(wanted, key, ["fecha", ordinal], part_bytes=part_bytes)
    return parts.join(chosen, key).select(*key, "notas", "total", "parte", "partes", "texto")


def _worth_gathering(members: DataFrame, chosen: DataFrame, key: list[str]) -> DataFrame:
    """Drops members of second-choice keys nobody chose, when the chosen ones are few.

    An aviso is always chosen by its own notes. Where many other keys were chosen, everything is
    gathered and the join with `chosen` drops the rest.
    """
    second = F.col("tipo").isin("siniestro", "placa")
    few = chosen.where(second).select(*key).limit(skew.HEAVY_LIST_MAX + 1).collect()
    if len(few) > skew.HEAVY_LIST_MAX:
        return members
    listed = members.sparkSession.createDataFrame(few, chosen.select(*key).schema).withColumn("_listed", F.lit(True))
    return members.join(F.broadcast(listed), key, "left").where(~second | F.col("_listed")).drop("_listed")


def split_pieces(cases: DataFrame, keys: list[str], joined: str) -> DataFrame:
    """Pieces of a bar-separated timeline: pos (counted on over parts), fecha (or desconocida), texto, dia.

    Splitting reads one row at a time; order by `dia` where a consumer needs the pieces in order.
    """
    before = F.col("piezas_antes") if "piezas_antes" in cases.columns else F.lit(0)
    pieces = cases.select(*keys, before.alias("_before"), F.posexplode(F.split(joined, r"\|")).alias("_at", "_piece"))
    pieces = pieces.withColumn("pos", F.col("_before") + F.col("_at"))
    pieces = pieces.select(*keys, "pos", tx.strip_blank(F.col("_piece")).alias("texto")).where("texto <> ''")
    found = F.nullif(F.regexp_extract("texto", r"^\d{4}-\d{2}-\d{2}", 0), F.lit(""))
    return pieces.withColumns(
        {"fecha": F.coalesce(found, F.lit("desconocida")), "dia": found.try_cast("date")}
    )
