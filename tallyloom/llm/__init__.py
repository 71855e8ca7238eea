"""Operators for preparing training corpora: quality, near copies, leaks, licences, packing, sharding, archives."""
