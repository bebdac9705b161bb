"""The streaming lot P&L equals the batch job over the same files, and resumes
from its checkpoint when more files arrive."""
import os
import tempfile

from conftest import rows
from strata.plans import ledger
from strata.sources import staging
from strata.sources.tables import Tables
from strata.streaming import current_lot_pnl, run_lot_pnl


def test_stream_matches_batch_and_resumes(spark):
    base = tempfile.mkdtemp(prefix="strata-stream-", dir="/tmp")
    src, out, ckpt = (os.path.join(base, d) for d in ("src", "out", "ckpt"))
    txn = staging.ledger(Tables(spark, "/root/testdata/sf0.001"))
    first = txn.filter("txn_id % 2 = 0")     # two arrivals of the same ledger
    second = txn.filter("txn_id % 2 = 1")
    first.write.parquet(os.path.join(src, "part=1"))
    q = run_lot_pnl(spark, src, txn.schema, out, ckpt)
    q.awaitTermination()
    assert rows(current_lot_pnl(spark, out)) == rows(ledger.lot_pnl(first))
    second.write.parquet(os.path.join(src, "part=2"))
    q = run_lot_pnl(spark, src, txn.schema, out, ckpt)
    q.awaitTermination()
    assert rows(current_lot_pnl(spark, out)) == rows(ledger.lot_pnl(txn))
