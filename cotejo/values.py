"""Fixed values that results must reproduce literally."""

# Texts written into or compared with data.
NOT_FOUND = "no localizado"
MISSING_TEXT = "nan"
ACTIVE = "Vigente"
CANCELLED = "Cancelado"
UNKNOWN = "Desconocido"
TOTAL_LABEL = "Total"
SUBTOTAL_LABEL = "Subtotal"
GRAND_TOTAL_LABEL = "Grand total"

# Strings that mean "no value" (compared trimmed and lower-cased).
NULL_MARKERS = ("", "nat", "nan", "none", "null", "n/a", "<na>")
PAYMENT_NULL_MARKERS = ("", "nat", "nan", "none", "null")

# Date sentinel, snapshot span, portal limit, ledger tolerance.
NO_DATE = "1900-01-01 00:00:00"
GROUP_SPAN_HOURS = 2
PORTAL_ROW_CAP = 100
LEDGER_TOLERANCE_SECONDS = 1

# Column sets of the domain tables.
HISTORY_KEY = ("numero_orden_suministro", "file_date")
HISTORY_DROPPED = ("rfc_proveedor", "razon_social", "almacen_entrega", "entidad_destino", "nombre_unidad")
HISTORY_DATES = ("fecha_autorizacion", "fecha_limite_entrega")
HISTORY_INTEGERS = ("precio_unitario", "cantidad_solicitada")
HISTORY_NUMBERS = ("Importe", "PENA")
PAYMENT_KEY = ("file_name", "folio_fiscal")
PAYMENT_COLUMNS = ("folio_fiscal", "referencia", "importe", "clc")
INVOICE_LINE_COLUMNS = ("UUID", "Folio", "Fecha", "Nombre", "Rfc", "Descripcion", "Cantidad", "Importe", "Archivo")
