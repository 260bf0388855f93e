SELECT estado_de_la_factura, sum(importe) AS importe
FROM historico
GROUP BY estado_de_la_factura
