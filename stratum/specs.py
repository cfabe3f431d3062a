"""One merge specification per entity; the merge operators are driven by these alone."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class MergeSpec:
    """How pending staging rows of one entity reach its silver table.

    ``style`` selects the literal merge:

    * ``A``  simple key, every pending row is a candidate
    * ``B``  simple key, only the newest pending row of a key
    * ``C``  composite key, all rows at the newest pending load time of a key
    * ``D``  composite key, every pending row, bookkeeping by row id
    * ``E``  deduplicated upsert without history
    """

    entity: str
    style: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    renames: dict[str, str] = field(default_factory=dict)  # silver name -> staging name

    @property
    def business(self) -> tuple[str, ...]:
        return self.keys + self.tracked

    def staging_column(self, silver_column: str) -> str:
        return self.renames.get(silver_column, silver_column)


_PLACE = {"city": "location_city", "country": "location_country"}

SPECS: dict[str, MergeSpec] = {
    s.entity: s
    for s in (
        MergeSpec("customers", "A", ("customer_id",), ("name", "city", "country"), _PLACE),
        MergeSpec("provider", "A", ("provider_id",), ("name", "city", "country"), _PLACE),
        MergeSpec("flavours", "A", ("flavour_id",), ("name", "description")),
        MergeSpec("rawmaterialtype", "A", ("raw_material_type_id",), ("name",)),
        MergeSpec(
            "ingredientsrawmaterial", "A", ("ingredient_rawmaterial_id",), ("ingredient_id", "raw_material_type_id")
        ),
        MergeSpec(
            "ingredients",
            "B",
            ("ingredient_id",),
            ("name", "chemical_formula", "molecular_weight", "cost_per_gram", "provider_id"),
        ),
        # The quantity belongs to the key: a changed quantity is a new recipe line.
        MergeSpec("recipes", "C", ("recipe_id", "flavour_id", "ingredient_id", "quantity_grams"), ("heat_process",)),
        MergeSpec("stocks", "D", ("stock_id", "flavour_id"), ("quantity_liters", "location", "batch_value")),
        MergeSpec(
            "salestransactions",
            "E",
            ("transaction_id",),
            (
                "customer_id",
                "flavour_id",
                "quantity_liters",
                "transaction_date",
                "country",
                "town",
                "postal_code",
                "amount_dollar",
            ),
        ),
    )
}

HISTORY_ENTITIES = tuple(e for e, s in SPECS.items() if s.style != "E")
