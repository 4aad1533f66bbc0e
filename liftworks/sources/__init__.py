from liftworks.sources.files import (  # noqa: F401
    read_csv,
    read_metadata_csv,
    read_parquet,
    write_csv,
    write_metrics,
    write_parquet,
)
from liftworks.sources.keyed import Keyed, join_keyed, keyed  # noqa: F401
from liftworks.sources.staging import exists, fresh_dir, release, stage, staging_root  # noqa: F401
