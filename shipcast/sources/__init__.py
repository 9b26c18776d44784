from shipcast.sources.tables import TABLES, read_table  # noqa: F401
from shipcast.sources.shipments import shipments, train_test  # noqa: F401
