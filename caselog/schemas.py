"""Explicit schemas of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(pairs: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs.items()])


TEXT, WHOLE, REAL, FLAG = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TEXTS = T.ArrayType(T.StringType())

# The header of the note files and its snake_case form.
NOTE_HEADER = {
    "NUMERO AVISO": "numero_aviso",
    "NUMERO SINIESTRO": "numero_siniestro",
    "NIT TALLER": "nit_taller",
    "NOMBRE TALLER": "nombre_taller",
    "PLACA": "placa",
    "FECHA OBSERVACION": "fecha_observacion",
    "USUARIO": "usuario",
    "ROL ANALISTA": "rol_analista",
    "OBSERVACION": "observacion",
}
REQUIRED_NOTE_COLUMN = "NOMBRE TALLER"

# The six note classes and the confidence words.
CLASSES = [
    "comunicacion_cliente",
    "gestion_repuestos",
    "cambio_estado",
    "comunicacion_interna",
    "sin_cambio",
    "sin_clasificar",
]
LAST_CLASS = CLASSES[-1]
CONFIDENCE = ["baja", "media", "alta"]

CLASSIFIED = _fields(
    {name: TEXT for name in NOTE_HEADER.values()}
    | {
        "estado_aviso": TEXT,
        "clasificacion": TEXT,
        "explicacion": TEXT,
        "confianza": REAL,
        "explicacion_clasificacion": TEXT,
        "confianza_clasificacion": REAL,
        "calidad_comunicativa_score": WHOLE,
        "explicacion_calidad": TEXT,
        "elementos_faltantes": TEXTS,
    }
)

UPSERT_KEY = ["numero_aviso", "numero_siniestro", "fecha_observacion", "usuario"]
UPSERT_TARGET = _fields(
    {
        "nit_taller": TEXT,
        "nombre_taller": TEXT,
        "numero_aviso": T.LongType(),
        "numero_siniestro": T.LongType(),
        "placa": TEXT,
        "fecha_observacion": T.TimestampType(),
        "usuario": TEXT,
        "rol_analista": TEXT,
        "observacion": TEXT,
        "clasificacion": TEXT,
        "explicacion": TEXT,
        "confianza": T.DecimalType(5, 3),
    }
)

RESPONSES = _fields(
    {"request_id": TEXT, "step": TEXT, "attempt": WHOLE, "raw": TEXT, "error": TEXT}
)

SCORE_PARTS = ["informatividad", "oportunidad", "orientacion", "claridad", "consistencia"]
AUDIT_FLAT = _fields(
    {"resumen_general": TEXT}
    | {
        f"{part}_{suffix}": kind
        for part in SCORE_PARTS
        for suffix, kind in (("score_0a100", WHOLE), ("justificacion", TEXT))
    }
    | {"score_final_0a100": WHOLE, "evidencias": TEXTS, "observaciones": TEXTS, "confianza": TEXT}
)

ALERTS_ANSWER = _fields(
    {
        "alerta_desistimiento_caso_omiso": _fields(
            {"detectada": FLAG, "nivel_riesgo": TEXT, "explicacion": TEXT}
        ),
        "alertas_comunicacion_cliente": _fields(
            {
                "nivel_alerta": TEXT,
                "codigo_visual": TEXT,
                "mensaje_principal": TEXT,
                "requiere_accion_inmediata": FLAG,
                "metricas_deteccion": _fields(
                    {
                        "total_observaciones": WHOLE,
                        "observaciones_con_contacto_cliente": WHOLE,
                        "porcentaje_comunicacion_cliente": REAL,
                        "fechas_contacto_documentado": TEXTS,
                        "dias_entre_contactos": T.ArrayType(WHOLE),
                        "brecha_maxima_sin_contacto_dias": WHOLE,
                        "frecuencia_promedio_contacto_dias": REAL,
                    }
                ),
            }
        ),
        "alerta_opre_tiempos": _fields(
            {
                "estado_semaforo": TEXT,
                "brecha_maxima_silencio_dias": WHOLE,
                "estancamiento_fase_detectado": FLAG,
                "justificacion": TEXT,
            }
        ),
        "sistema_antiquejas_riesgos": _fields(
            {
                "nivel_riesgo_queja": TEXT,
                "factores_activados": _fields(
                    {
                        "riesgo_legal": FLAG,
                        "problemas_repuestos": FLAG,
                        "reprogramacion_fechas": FLAG,
                    }
                ),
                "palabras_clave_halladas": TEXTS,
            }
        ),
    }
)

QUALITY_ANSWER = _fields(
    {
        "evaluacion_calidad_observaciones": _fields(
            {
                "score_final_0a100": WHOLE,
                "categoria_general": TEXT,
                "metricas_detalladas": _fields(
                    {
                        "informatividad": _fields(
                            {
                                "score_0a100": WHOLE,
                                "observaciones_informativas": WHOLE,
                                "observaciones_genericas": WHOLE,
                                "porcentaje_informativo": REAL,
                                "justificacion": TEXT,
                            }
                        ),
                        "oportunidad": _fields(
                            {
                                "score_0a100": WHOLE,
                                "brecha_maxima_dias": WHOLE,
                                "brecha_promedio_dias": REAL,
                                "brecha_minima_dias": WHOLE,
                                "nivel_proactividad": TEXT,
                                "justificacion": TEXT,
                            }
                        ),
                        "orientacion": _fields(
                            {
                                "score_0a100": WHOLE,
                                "explica_causas": FLAG,
                                "comunica_plazos": FLAG,
                                "describe_siguientes_pasos": FLAG,
                                "gestiona_expectativas": FLAG,
                                "justificacion": TEXT,
                            }
                        ),
                        "claridad": _fields(
                            {
                                "score_0a100": WHOLE,
                                "nivel_especificidad": TEXT,
                                "uso_jerga_sin_explicar": FLAG,
                                "justificacion": TEXT,
                            }
                        ),
                        "consistencia": _fields(
                            {
                                "score_0a100": WHOLE,
                                "secuencia_logica": FLAG,
                                "contradicciones_detectadas": WHOLE,
                                "justificacion": TEXT,
                            }
                        ),
                    }
                ),
            }
        ),
        "evidencias_representativas": TEXTS,
        "recomendaciones_priorizadas": TEXTS,
        "estadisticas_caso": _fields(
            {
                "metricas_temporales": _fields(
                    {
                        "total_observaciones": WHOLE,
                        "fecha_primera_observacion": TEXT,
                        "fecha_ultima_observacion": TEXT,
                        "dias_duracion_caso": WHOLE,
                        "observaciones_por_semana": REAL,
                        "dias_habiles_transcurridos": WHOLE,
                    }
                ),
                "metricas_contenido": _fields(
                    {
                        "palabras_promedio_por_observacion": REAL,
                        "observaciones_con_fechas_especificas": WHOLE,
                        "observaciones_con_plazos_estimados": WHOLE,
                        "repeticiones_detectadas": WHOLE,
                    }
                ),
            }
        ),
    }
)
