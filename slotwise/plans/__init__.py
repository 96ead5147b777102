from slotwise.plans.clean import clean
from slotwise.plans.run import JdbcStore, JsonStore, Report, Store, TableStore, run

__all__ = ["JdbcStore", "JsonStore", "Report", "Store", "TableStore", "clean", "run"]
