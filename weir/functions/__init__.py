from weir.functions.guards import check_sql_text
from weir.functions.money import amount_sql, cents_sql, exact_sum, to_cents, whole_to_amount
from weir.functions.ranks import nearest_rank

__all__ = ["amount_sql", "cents_sql", "check_sql_text", "exact_sum", "nearest_rank", "to_cents", "whole_to_amount"]
