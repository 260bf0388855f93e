"""Raw text, XML and HTML queries: documents written from the tables by Spark are read back and checked."""

from pyspark.sql import functions as F

from cotejo.catalog.registry import register
from cotejo.sources import csv_dialect, html_tables, invoice_xml, receipts, records


def _text(column):
    return F.col(column).cast("string")


def _csv_lines(t):
    """One raw line per order; the last digit of the key decides which quirk of the dialect it carries."""
    key, priority, slash = _text("o_orderkey"), F.col("o_orderpriority"), F.lit("\\")
    lines = [
        F.concat_ws(",", key, priority, F.lit("plain")),
        F.concat(key, F.lit(","), priority, slash, F.lit(",tail,unquoted")),
        F.concat(key, F.lit(',"p""'), priority, F.lit('""q",doubled')),
        F.concat(key, F.lit(',"x'), slash, F.lit('"'), priority, F.lit(', y",escaped')),
        F.concat(key, F.lit(","), slash, F.lit("N,marker")),
        F.concat_ws(",", key, priority, F.lit("wide"), F.lit("extra")),
        F.concat_ws(",", key, priority),
        F.concat_ws(",", key, priority, F.lit("wide"), F.lit("")),
        F.concat(key, F.lit(",NULL,"), slash, F.lit("t"), slash, slash),
        F.concat_ws(",", key, F.lit('""'), F.lit(" padded ")),
    ]
    choice = F.lit(None).cast("string")
    for digit, line in enumerate(lines):
        choice = F.when(F.col("o_orderkey") % 10 == digit, line).otherwise(choice)
    return t["orders"].select(F.col("o_orderkey").alias("line_id"), choice.alias("line"))


@register(
    """SELECT o_orderkey AS line_id, CAST(o_orderkey AS VARCHAR) AS id,
              CASE o_orderkey % 10 WHEN 1 THEN o_orderpriority || ',tail' WHEN 2 THEN 'p"' || o_orderpriority || '"q'
                   WHEN 3 THEN 'x"' || o_orderpriority || ', y' WHEN 4 THEN NULL WHEN 8 THEN NULL WHEN 9 THEN NULL
                   ELSE o_orderpriority END AS note,
              CASE o_orderkey % 10 WHEN 0 THEN 'plain' WHEN 1 THEN 'unquoted' WHEN 2 THEN 'doubled' WHEN 3 THEN 'escaped'
                   WHEN 4 THEN 'marker' WHEN 8 THEN 't' || chr(92) WHEN 9 THEN ' padded ' END AS kind
       FROM orders WHERE o_orderkey % 10 NOT IN (5, 7)""",
    name="csv_dialect",
)
def csv_lines(t):
    return csv_dialect.parse_lines(_csv_lines(t), ["id", "note", "kind"])


@register(
    """SELECT CAST(o_orderkey AS VARCHAR) AS id,
              CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority
                   ELSE 'a "' || o_orderpriority || chr(10) || chr(10) || 'b, c' || chr(92) || chr(10) || o_orderstatus END AS note,
              o_orderstatus AS kind
       FROM orders"""
)
def csv_line_breaks(t):
    """Orders in seven files, most of them records of four lines; slices end anywhere, within records too."""
    key, priority, status = _text("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    several = F.concat(key, F.lit(',"a ""'), priority, F.lit('\n\nb, c\\\\\n'), status, F.lit('",'), status)
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat_ws(",", key, priority, status)).otherwise(several)
    lines = t["orders"].select(
        F.format_string("f%d", F.col("o_orderkey") % 7).alias("file"), F.posexplode(F.split(text, "\n")).alias("part", "line"), "o_orderkey"
    )
    place = F.col("o_orderkey") * 4 + F.col("part")
    sliced = lines.select("file", F.expr("(o_orderkey * 4 + part) div 1003").alias("block"), place.alias("line_id"), "line")
    return csv_dialect.parse_lines(records.records_of_lines(sliced), ["id", "note", "kind"]).select("id", "note", "kind")


def _csv_files(t):
    """Lines of five files: two orders of the columns, a narrow header, an unknown one; some lines are too wide."""
    key, status, priority = _text("o_orderkey"), F.col("o_orderstatus"), F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(',"'))
    part = F.col("o_orderkey") % 5
    body = (
        F.when(F.col("o_orderkey") % 17 == 0, F.concat_ws(",", key, status, priority, key, key))
        .when(part == 0, F.concat_ws(",", status, key, priority))
        .when(part == 1, F.concat_ws(",", key, status))
        .otherwise(F.concat_ws(",", key, status, priority))
    )
    lines = t["orders"].select(F.format_string("f%d", part).alias("file"), F.col("o_orderkey").alias("pos"), body.alias("line"))
    heads = lines.groupBy("file").agg(F.lit(-1).cast("bigint").alias("pos"))
    head = F.when(F.col("file") == "f0", F.lit("status,id,note")).when(F.col("file") == "f4", F.lit("id,status,other"))
    return lines.unionByName(heads.withColumn("line", head.otherwise(F.lit("id,status,note"))))


CSV_FILES = """
    WITH l AS (SELECT *, 'f' || (o_orderkey % 5) AS file, o_orderkey % 17 = 0 AS wide FROM orders)
    SELECT {columns} FROM l WHERE {where}"""


@register(
    CSV_FILES.format(
        columns="""file, o_orderkey AS pos, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
                   CASE WHEN file <> 'f1' THEN o_orderpriority || ',' END AS note""",
        where="file <> 'f4' AND NOT wide",
    )
)
def csv_files(t):
    return csv_dialect.rows_by_header(csv_dialect.split_cells(_csv_files(t), 8), ["id", "status", "note"])[0].drop("line")


@register(
    CSV_FILES.format(
        columns="file, o_orderkey AS pos, CASE WHEN file = 'f4' THEN 'unknown header' ELSE 'too many cells' END AS reason",
        where="file = 'f4' OR wide",
    )
    + " UNION ALL SELECT DISTINCT 'f4', -1, 'unknown header' FROM orders WHERE o_orderkey % 5 = 4"
)
def csv_rejects(t):
    rows = csv_dialect.split_cells(_csv_files(t), 8)
    return csv_dialect.rows_by_header(rows, ["id", "status", "note"])[1].select("file", "pos", "reason")


def _xml_texts(t):
    """One invoice document per line item, in all the states the reader must tell apart."""
    line = F.col("l_linenumber")
    version = F.when(line % 4 == 0, F.lit("cfd/3")).when(line % 4 == 2, F.lit("cfd/2")).otherwise(F.lit("cfd/4"))
    prefix = F.when(line == 5, F.lit("c")).otherwise(F.lit("cfdi"))
    receiver = F.when(line != 3, F.format_string('<%s:Receptor Nombre="N&amp;%d" Rfc="R%d"/>', prefix, "l_suppkey", "l_suppkey"))
    series = F.when(F.col("l_partkey") % 2 == 0, F.lit('Serie="S" ')).otherwise(F.lit(""))
    concepts = F.format_string(
        '<%s:Conceptos><%s:Concepto Descripcion="part %d" Cantidad="%s" Importe="%s"/>'
        '<%s:Concepto Descripcion="tax" Cantidad="1" Importe="%s"/></%s:Conceptos>',
        prefix, prefix, "l_partkey", _text("l_quantity"), _text("l_extendedprice"), prefix, _text("l_tax"), prefix,
    )
    stamp = F.when(
        F.col("l_partkey") % 7 != 0,
        F.format_string(
            '<%s:Complemento><t:TimbreFiscalDigital xmlns:t="http://www.sat.gob.mx/TimbreFiscalDigital" UUID="U%d"/></%s:Complemento>',
            prefix, "l_partkey", prefix,
        ),
    ).otherwise(F.lit(""))
    text = F.concat(
        F.format_string(
            '<?xml version="1.0" encoding="UTF-8"?>\n<%s:Comprobante xmlns:%s="http://www.sat.gob.mx/%s" %sFolio="00%d" Fecha="2024-01-01">',
            prefix, prefix, version, series, "l_partkey",
        ),
        F.coalesce(receiver, F.lit("")),
        concepts,
        stamp,
        F.when(line != 7, F.format_string("</%s:Comprobante>", prefix)).otherwise(F.lit("<cut")),
    )
    name = F.format_string("f%d-%d.xml", "l_orderkey", "l_linenumber")
    return t["lineitem"].select(name.alias("file_name"), text.alias("text"))


@register(
    """WITH docs AS (SELECT * FROM lineitem WHERE l_linenumber % 4 <> 2 AND l_linenumber NOT IN (3, 7)),
       items AS (SELECT *, 0 AS line_no, 'part ' || l_partkey AS d, l_quantity AS q, l_extendedprice AS i FROM docs
                 UNION ALL SELECT *, 1, 'tax', 1.0, l_tax FROM docs)
       SELECT CASE WHEN l_partkey % 7 <> 0 THEN 'U' || l_partkey END AS "UUID",
              CASE WHEN l_partkey % 2 = 0 THEN 'S-' ELSE '' END || '00' || l_partkey AS "Folio", '2024-01-01' AS "Fecha",
              'N&' || l_suppkey AS "Nombre", 'R' || l_suppkey AS "Rfc", d AS "Descripcion", CAST(q AS DOUBLE) AS "Cantidad",
              i AS "Importe", 'f' || l_orderkey || '-' || l_linenumber || '.xml' AS "Archivo", line_no FROM items"""
)
def xml_invoice_lines(t):
    parsed = invoice_xml.parse_documents(_xml_texts(t))
    return invoice_xml.line_items(invoice_xml.headers(parsed))


@register("""SELECT 'f' || l_orderkey || '-' || l_linenumber || '.xml' AS file_name FROM lineitem WHERE l_linenumber = 7""")
def xml_rejects(t):
    return invoice_xml.rejects(invoice_xml.parse_documents(_xml_texts(t))).select("file_name")


@register(
    """WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n, text FROM documents)
       SELECT CASE WHEN doc_id % 5 <> 0 THEN 'ab' || doc_id || 'cd' END AS uuid,
              CASE WHEN contains(text, 'Cancelado') OR doc_id % 3 = 0 THEN 'Cancelado'
                   WHEN contains(text, 'Vigente') OR doc_id % 3 = 1 THEN 'Vigente' ELSE 'Desconocido' END AS estado,
              'r' || doc_id || '.pdf' AS filename FROM documents"""
)
def receipt_status(t):
    """Whole documents with a receipt's id mark and status word written into them."""
    key = _text("doc_id")
    mark = F.when(F.col("doc_id") % 5 == 0, F.lit("&id=&RE")).otherwise(
        F.concat(F.when(F.col("doc_id") % 2 == 0, F.lit("&ID=ab ")).otherwise(F.lit("&id=ab\n")), key, F.lit(" c\r\nd&Re=x"))
    )
    status = (
        F.when(F.col("doc_id") % 3 == 0, F.lit("Vigente, antes Cancelado"))
        .when(F.col("doc_id") % 3 == 1, F.lit("Vigente"))
        .otherwise(F.lit("cancelado"))
    )
    texts = t["documents"].select(
        F.concat_ws("\n", "text", mark, status).alias("text"), F.format_string("r%d.pdf", "doc_id").alias("filename")
    )
    return receipts.receipt_status(texts)


@register(
    """WITH found AS (SELECT page_id, regexp_extract_all(html, '(?is)<(?:ul)(?:\\s[^>]*)?>(.*?)</(?:ul)\\s*>', 1) AS uls FROM pages),
       lists AS (SELECT page_id, unnest(uls) AS ul, generate_subscripts(uls, 1) - 1 AS container_no FROM found),
       items AS (SELECT page_id, container_no, unnest(regexp_extract_all(ul, '(?is)<(?:li)(?:\\s[^>]*)?>(.*?)</(?:li)\\s*>', 1)) AS item,
                 generate_subscripts(regexp_extract_all(ul, '(?is)<(?:li)(?:\\s[^>]*)?>(.*?)</(?:li)\\s*>', 1), 1) - 1 AS row_no FROM lists)
       SELECT page_id, container_no, row_no, trim(regexp_replace(replace(replace(replace(replace(replace(replace(
                  regexp_replace(item, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
                  '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g')) AS item FROM items"""
)
def html_list_items(t):
    rows = html_tables.element_rows(t["pages"], "page_id", "html", "ul", "li")
    return rows.select("page_id", "container_no", "row_no", F.element_at("cells", 1).alias("item"))


def _html_tables(t):
    """One page per order with its result table; the column order differs from page to page."""
    key, priority = _text("o_orderkey"), F.replace("o_orderpriority", F.lit("-"), F.lit(" &amp;\n  "))
    head = F.when(
        F.col("o_orderkey") % 2 == 0, F.lit("<thead><tr class='h'><th>Orden</th><th> Estado </th></tr></thead>")
    ).otherwise(F.lit("<tr><TH>Estado</TH><th>Orden</th></tr>"))
    cells = [F.concat(F.lit("<td><b>"), key, F.lit("</b></td>")), F.concat(F.lit("<td align='x'>"), priority, F.lit("</td>"))]
    row = F.when(F.col("o_orderkey") % 2 == 0, F.concat(*cells)).otherwise(F.concat(*reversed(cells)))
    html = F.concat(
        F.lit("<html><body><table id='t'>"), head, F.lit("<tr>"), row, F.lit("</tr><tr><td></td><td>&lt;x&gt;</td></tr>"),
        F.lit("</table><table><tr><td>second</td></tr></table></body></html>"),
    )
    return t["orders"].select(F.col("o_orderkey").alias("page"), html.alias("html"))


@register(
    """SELECT o_orderkey AS page, CAST(1 AS BIGINT) AS row_no, CAST(o_orderkey AS VARCHAR) AS "Orden",
              replace(o_orderpriority, '-', ' & ') AS "Estado" FROM orders
       UNION ALL SELECT o_orderkey, 2, CASE WHEN o_orderkey % 2 = 1 THEN '<x>' END,
              CASE WHEN o_orderkey % 2 = 0 THEN '<x>' END FROM orders"""
)
def html_table_rows(t):
    rows = html_tables.table_rows(_html_tables(t), "page")
    return html_tables.named_cells(rows, ["Orden", "Estado"])
