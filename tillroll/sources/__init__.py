from tillroll.sources.schema import SPECS, TableSpec
from tillroll.sources.text import Parsed, load_table, parse, read_lines

__all__ = ["SPECS", "Parsed", "TableSpec", "load_table", "parse", "read_lines"]
