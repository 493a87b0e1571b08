"""Writers: tab-separated export, slice replacement on disk, JSON dimensions, DDL."""
