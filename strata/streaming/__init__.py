"""Incremental runners.  The reference is batch only; the one incremental
shape it implies is a ledger that grows as transaction files land, so the lot
profit and loss is offered as a Structured Streaming job with the same result
as the batch job over the same files."""
from strata.streaming.ledger import current_lot_pnl, run_lot_pnl  # noqa: F401
