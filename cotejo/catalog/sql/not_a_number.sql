SELECT CAST(estado_de_la_factura AS INT) AS code FROM historico WHERE estado_de_la_factura IS NOT NULL
