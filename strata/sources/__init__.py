from strata.sources.files import read_raw_csv, write_csv  # noqa: F401
from strata.sources.store import LayerStore, SchemaMismatchError  # noqa: F401
