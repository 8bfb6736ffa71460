from starhouse.sources.csv_text import read_text_csv, with_lineage
from starhouse.sources.json_pages import flatten_pages, read_pages, union_pulls
from starhouse.sources.literal import static_dim

__all__ = ["flatten_pages", "read_pages", "read_text_csv", "static_dim", "union_pulls", "with_lineage"]
