"""Small pieces of SQL text shared by the SQL twins."""

from __future__ import annotations

from caselog.plans.inputs import NOTES_SQL

SPACES = r"[\s\x{000B}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{001C}-\x{001F}]+"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACES}|{SPACES}$', '', 'g')"


def squeeze(x: str) -> str:
    return f"regexp_replace({x}, '{SPACES}', ' ', 'g')"


def squeeze_strip(x: str) -> str:
    return f"trim({squeeze(x)})"


def clean(x: str) -> str:
    return f"regexp_replace({strip(f'coalesce(CAST({x} AS VARCHAR), {chr(39)}{chr(39)})')}, '^=', '')"


def fold(x: str) -> str:
    return f"strip_accents(lower({x}))"


def has_any(x: str, words: list[str]) -> str:
    """Phrases at the start of a word; a trailing space stands for the end of one."""
    texts = [
        ("(^|[^a-z0-9])" if w[0] != " " else "") + w.rstrip(" ") + ("($|[^a-z0-9])" if w[-1] == " " else "")
        for w in words
    ]
    return f"coalesce(regexp_matches({x}, '" + "|".join(f"({t})" for t in texts) + "'), FALSE)"


def words(x: str) -> str:
    flat = squeeze_strip(x)
    return f"CASE WHEN coalesce({flat}, '') = '' THEN 0 ELSE len(string_split({flat}, ' ')) END"


CLEANED = ["numero_aviso", "numero_siniestro", "placa", "usuario", "rol_analista", "observacion", "clasificacion"]
TIMELINE_FORMATS = "['%Y/%m/%d %I:%M:%S %p', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d']"
# Cleaned notes with their parsed date and event text, as a WITH list.
EVENTS_CTE = (
    f"notes AS ({NOTES_SQL}), cleaned AS (SELECT ord, dia, caso, nit_taller, nombre_taller, "
    + ", ".join(f"{clean(c)} AS {c}" for c in CLEANED)
    + f", {squeeze_strip(clean('fecha_observacion'))} AS fecha_obs_norm FROM notes), "
    f"dated AS (SELECT *, try_strptime(fecha_obs_norm, {TIMELINE_FORMATS}) AS fecha_dt FROM cleaned), "
    "ev AS (SELECT *, coalesce(strftime(fecha_dt, '%Y-%m-%d'), fecha_obs_norm) AS fecha_fmt, "
    f"CASE WHEN {strip('observacion')} = '' THEN NULL ELSE coalesce(strftime(fecha_dt, '%Y-%m-%d'), fecha_obs_norm) "
    f"|| ' - ' || {strip('observacion')} || CASE WHEN clasificacion = '' THEN '' ELSE ' [' || clasificacion || ']' END "
    "END AS evento FROM dated)"
)
CASES_CTE = (
    EVENTS_CTE + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY numero_siniestro, placa "
    "ORDER BY fecha_dt NULLS FIRST, fecha_obs_norm, ord) AS pos FROM ev), "
    "cases AS (SELECT max(nit_taller) FILTER (pos = 1) AS nit_taller, max(nombre_taller) FILTER (pos = 1) AS nombre_taller, "
    "max(numero_aviso) FILTER (pos = 1) AS numero_aviso, numero_siniestro, placa, max(usuario) FILTER (pos = 1) AS usuario, "
    "max(rol_analista) FILTER (pos = 1) AS rol_analista, count(*) AS total_eventos, count(evento) AS eventos_no_vacios, "
    "CAST(0 AS BIGINT) AS parte, CAST(1 AS BIGINT) AS partes, CAST(0 AS BIGINT) AS piezas_antes, coalesce(string_agg(evento, ' | ' ORDER BY pos), '') AS observaciones_unidas "
    "FROM ranked GROUP BY numero_siniestro, placa)"
)
