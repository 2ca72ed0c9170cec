from riskspark.sources.tables import read_table, order_risk, line_num, doc_risk, emb, event_num, TABLE_BUILDERS

__all__ = ["read_table", "order_risk", "line_num", "doc_risk", "emb", "event_num", "TABLE_BUILDERS"]
