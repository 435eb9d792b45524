"""Measures of a station."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def utilization(bikes="num_bikes_available", docks="num_docks_available") -> Column:
    """Share of the usable places that hold a bike.

    Null for a station that reports neither bikes nor docks, which averages then leave out. The sum is taken on doubles,
    so that extreme counts cannot overflow.
    """
    bikes = F.col(bikes).cast("double")
    return F.try_divide(bikes, bikes + F.col(docks).cast("double"))
