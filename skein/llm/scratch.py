"""Where jobs cut lineage: tables written to the folder the cluster shares (see :mod:`skein.sources.work`)."""

from skein.sources.work import cleared, delete, new_path, shared_dir, written

__all__ = ["cleared", "delete", "new_path", "shared_dir", "written"]
