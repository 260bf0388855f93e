SELECT numero_orden_suministro, estado_de_la_factura, importe
FROM historico
WHERE file_date = (SELECT max(file_date) FROM historico);
