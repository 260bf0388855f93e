SELECT no_such_column FROM historico
