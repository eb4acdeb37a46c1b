"""Domain phrase lists, all in folded form (lower case, no accents)."""

from __future__ import annotations

# Phrases that show contact with the customer.
CONTACT_PHRASES = [
    "informo al cliente",
    "cliente notificado",
    "llamada al cliente",
    "whatsapp enviado",
    "correo al cliente",
    "cliente confirmo",
    "cliente aprobo",
    "conversacion con cliente",
    "mensaje enviado",
    "actualizacion al cliente",
    "contactado cliente",
]

# Verbs and channels that count as contact when a case is closed.
CONTACT_VERBS = ["llamada", "correo", "whatsapp"]

# Words for a closed or withdrawn case.
CLOSED_WORDS = ["caso cerrado", "cierra el caso", "se cierra", "desist"]

# Words that announce a complaint, by factor.
COMPLAINT_WORDS = ["abogado", "superintendencia", "demanda", "reproceso"]
LEGAL_WORDS = ["abogado", "superintendencia", "demanda"]
PARTS_WORDS = ["pendiente repuesto", "pendiente por repuesto", "repuesto danado", "backorder"]
RESCHEDULE_WORDS = ["reprogram", "se aplaza", "nueva fecha"]

# Repair phases in their natural order, with the words that name each.
PHASES = {
    "recepcion": ["recepcion"],
    "diagnostico": ["diagnostico"],
    "cotizacion": ["cotizacion"],
    "reparacion": ["reparacion", "latoneria", "enderezado", "mecanica", "desarme"],
    "pintura": ["pintura"],
    "armado": ["armado"],
    "entrega": ["entrega"],
}

# Indicators of each note class, in order of priority.
CLASS_RULES = {
    "comunicacion_cliente": [
        "llama al cliente",
        "contacta al cliente",
        "informa al cliente",
        "cliente aprueba",
        "cliente rechaza",
        "cliente solicita",
        "cliente confirma",
        "envia cotizacion",
        "cotizacion enviada",
        "espera de respuesta del cliente",
        "whatsapp enviado",
        "cita ",
    ],
    "gestion_repuestos": [
        "repuesto",
        "pieza",
        "pedido",
        "importacion",
        "importado",
        "nacional",
        "backorder",
    ],
    "cambio_estado": [
        "ingresa a",
        "sale de",
        "se inicia",
        "se finaliza",
        "se completa",
        "pasa de",
        "se asigna tecnico",
        "se traslada",
        "pintura",
        "latoneria",
        "desarme",
        "mecanica",
        "enderezado",
        "en proceso",
        "iniciado",
        "finalizado",
    ],
    "comunicacion_interna": [
        "se consulta con",
        "autorizacion a la aseguradora",
        "cordial saludo",
        "proveedor",
        "perito",
    ],
    "sin_cambio": [
        "sin novedad",
        "sin cambios",
        "continua en",
        "sigue en",
        "pendiente de aprobacion",
        "a la espera",
        "en espera",
    ],
}

# Notes without content of their own.
GENERIC_WORDS = ["sin novedad", "sin cambios", "continua en", "sigue en", "en proceso", "pendiente"]

# A concrete calendar date, and words for an estimated term.
EXPLICIT_DATE = r"\b\d{4}-\d{1,2}-\d{1,2}\b|\b\d{1,2}/\d{1,2}(/\d{2,4})?\b"
ESTIMATED_TERM = r"\b\d+ (dia|semana|hora)s?\b|estimad|plazo"

BARE_PARTS_NOTE = r"^pendiente( por)? repuestos?\.?$"

# Priority of the elements a note may lack.
MISSING_PRIORITY = {
    "alta": ["fecha", "origen", "proximos pasos", "responsable"],
    "media": ["detalle", "tipo de trabajo", "estado actual", "ubicacion", "contingencia"],
}
