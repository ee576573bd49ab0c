"""The star schema the reports and measures run on."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame

from ledgerline.sources.layers import Change, Layers


class Star(Protocol):
    """Two dimensions and four facts, with the columns of the cleaned layer."""

    @property
    def dim_city(self) -> DataFrame: ...
    @property
    def dim_ad_category(self) -> DataFrame: ...
    @property
    def print_sales(self) -> DataFrame: ...
    @property
    def ad_revenue(self) -> DataFrame: ...
    @property
    def readiness(self) -> DataFrame: ...
    @property
    def pilot(self) -> DataFrame: ...


@dataclass(frozen=True)
class StoredStar:
    """A star schema of given tables, as a rule those of the cleaned layer."""

    dim_city: DataFrame
    dim_ad_category: DataFrame
    print_sales: DataFrame
    ad_revenue: DataFrame
    readiness: DataFrame
    pilot: DataFrame

    @classmethod
    def from_layer(cls, layers: Layers | Change, layer: str = "cleaned") -> StoredStar:
        """All tables of the newest version, or of a change that is under way."""
        if isinstance(layers, Layers):
            layers = layers.pinned()
        return cls(
            dim_city=layers.read(layer, "dim_city"),
            dim_ad_category=layers.read(layer, "dim_ad_category"),
            print_sales=layers.read(layer, "fact_print_sales"),
            ad_revenue=layers.read(layer, "fact_ad_revenue"),
            readiness=layers.read(layer, "fact_city_readiness"),
            pilot=layers.read(layer, "fact_digital_pilot"),
        )
