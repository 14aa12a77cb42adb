"""Written tables in the folder that the cluster shares, as the library has them."""

from ..scratch import discard, folder, step, written

__all__ = ["discard", "folder", "step", "written"]
