from silverlode.plans.batch import run_batch
from silverlode.plans.bronze import ingest
from silverlode.plans.gold import build_gold
from silverlode.plans.silver import build_silver

__all__ = ["build_gold", "build_silver", "ingest", "run_batch"]
