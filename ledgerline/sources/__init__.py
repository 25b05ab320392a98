from ledgerline.sources.files import (  # noqa: F401
    preview, register, scan_csv, scan_parquet, scan_parquet_dir, write_csv, write_table,
)
