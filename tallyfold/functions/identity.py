"""Who sent a request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# host:port and [host]:port; any other number of colons is not an address pair.
_HOST_PORT = r"^([^:\[\]]*):[^:\[\]]*$"
_BRACKET_HOST_PORT = r"^\[([^\[\]]*)\]:[^:\[\]]*$"
_OUTER_BLANKS = r"(?U)^\s+|\s+$"


def client_id(forwarded_for: Column, remote_addr: Column) -> Column:
    """First forwarded address, else the host of the peer, else the raw peer.

    The header is tested before it is split, so ``' ,b'`` gives an empty id.
    """
    first = F.regexp_replace(F.split(forwarded_for, ",", 2)[0], _OUTER_BLANKS, "")
    return (
        F.when(F.coalesce(forwarded_for, F.lit("")) != "", first)
        .when(remote_addr.rlike(_HOST_PORT), F.regexp_extract(remote_addr, _HOST_PORT, 1))
        .when(
            remote_addr.rlike(_BRACKET_HOST_PORT),
            F.regexp_extract(remote_addr, _BRACKET_HOST_PORT, 1),
        )
        .otherwise(remote_addr)
    )
