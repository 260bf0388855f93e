SELECT numero_orden_suministro FROM historico WHERE importe > 250000
