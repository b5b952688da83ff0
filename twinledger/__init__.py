"""Table reconciliation and table-metadata jobs as Spark DataFrame plans."""

from twinledger.plans.reconcile import Reconciliation, reconcile

__all__ = ["Reconciliation", "reconcile"]
