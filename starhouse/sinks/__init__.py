from starhouse.sinks.files import write_csv, write_fact, write_table
from starhouse.sinks.versions import new_version, publish, published_version

__all__ = ["new_version", "publish", "published_version", "write_csv", "write_fact", "write_table"]
