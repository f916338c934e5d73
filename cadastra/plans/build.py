"""The derivation steps in order; a numbered slice of them, or what a table needs, can be run alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.joins import union_parents
from ..operators.legal import derive_parcels
from ..operators.sinks import rebuild, run_jobs
from ..operators.steps import Step, run_steps
from ..session import Scratch, cut_lineage
from . import addresses, dims, land_values, layers, legacy, provenance, sales

Tables = dict[str, DataFrame]


def _step(job: int, name: str, reads: str, writes: str, run: Callable[[Tables], Tables], optional: bool = False) -> Step:
    return Step(job, name, tuple(reads.split()), tuple(writes.split()), run, optional=optional)


def _table(job: int, table: str, reads: str, make: Callable[..., DataFrame]) -> Step:
    """A step of one table, made from the tables it reads in their order."""
    names = tuple(reads.split())
    return Step(job, table, names, (table,), lambda t: {table: make(*[t[n] for n in names])})


_SALE_KINDS = ["ps_row_a_legacy", "ps_row_b_legacy", "ps_row_a", "ps_row_b", "ps_row_c", "ps_row_d"]


def _sources(t: Tables) -> Tables:
    by_line = provenance.land_value_provenance(t["land_value_row"])
    by_byte = provenance.sale_provenance({n: t[n] for n in _SALE_KINDS})
    return {
        "source_file_line": by_line["source_file_line"],
        "source_byte_position": by_byte["source_byte_position"],
        "file_source": union_parents([by_line["file_source"], by_byte["file_source"]]),
    }


def _layers(t: Tables) -> Tables:
    lots = layers.base_parcels(t["lot_feature_layer"], t["base_parcel"])
    lands = layers.principal_properties(t["property_feature_layer"], t["property"])
    return {
        "base_parcel": union_parents([t["base_parcel"], lots["base_parcel"]]),
        "base_parcel_geometry": lots["base_parcel_geometry"],
        "property": union_parents([t["property"], lands["property"]]),
        "property_geometry": lands["property_geometry"],
    }


#: Sub-results several steps read: written once to the shared folder where no step is saved.
SHARED = ("ranked_sales", "sale_descriptions", "legacy_sales")

STEPS: list[Step] = [
    _table(1, "epa_2006_zone", "land_value_row ps_row_b", dims.zones),
    _table(1, "primary_purpose", "ps_row_b", dims.primary_purposes),
    _table(1, "valuation_district", "land_value_row ps_row_b_legacy ps_row_a ps_row_b", dims.valuation_districts),
    _step(2, "sources", "land_value_row " + " ".join(_SALE_KINDS), "source_file_line source_byte_position file_source", _sources),
    _table(3, "property", "land_value_row ps_row_b ps_row_b_legacy", dims.properties),
    _table(4, "locality", "land_value_row ps_row_b", addresses.localities),
    _table(4, "street", "land_value_row ps_row_b", addresses.streets),
    _table(4, "address", "land_value_row ps_row_b", addresses.addresses),
    _table(5, "full_property_address", "address street locality", addresses.full_addresses),
    _table(6, "ranked_sales", "ps_row_b land_value_row", sales.ranked_sales),
    _table(6, "sale_descriptions", "ps_row_c ranked_sales", sales.sale_descriptions),
    _table(6, "legacy_sales", "ps_row_b_legacy ps_row_a_legacy ranked_sales", legacy.legacy_sales),
    _table(
        7, "legal_description", "land_value_row sale_descriptions",
        lambda lv, texts: union_parents([land_values.legal_descriptions(lv), sales.legal_descriptions(texts)]),
    ),
    _table(
        7, "property_area", "land_value_row ranked_sales legacy_sales",
        lambda lv, ranked, old: union_parents(
            [land_values.property_areas(lv), sales.property_areas(ranked), legacy.property_areas(old)]
        ),
    ),
    _table(
        7, "zone_observation", "land_value_row ranked_sales",
        lambda lv, ranked: union_parents([land_values.zone_observations(lv), sales.zone_observations(ranked)]),
    ),
    _table(7, "property_under_strata_plan", "land_value_row", land_values.under_strata_plan),
    _table(7, "land_valuation", "land_value_row", land_values.land_valuations),
    _table(7, "notice_of_sale", "ranked_sales ps_row_d", sales.notices_of_sale),
    _table(7, "property_primary_purpose", "ranked_sales primary_purpose", sales.primary_purposes),
    _table(7, "nature_of_property", "ranked_sales", sales.natures_of_property),
    _table(7, "notice_of_sale_archived", "legacy_sales", legacy.archived_sales),
    _table(7, "archived_legal_description", "legacy_sales", legacy.archived_descriptions),
    _table(7, "described_dimensions", "legacy_sales", legacy.described_dimensions),
    _step(
        8, "parcels", "legal_description",
        "base_parcel folio property_folio legal_description_remains enclosure_permit folio_rejects",
        lambda t: derive_parcels(t["legal_description"]),
    ),
    _step(
        9, "layers", "lot_feature_layer property_feature_layer base_parcel property",
        "base_parcel base_parcel_geometry property property_geometry", _layers, optional=True,
    ),
]


def build(
    raw: Tables, out: str | None = None, run_from: int | None = None, run_till: int | None = None
) -> Tables:
    """Run the jobs over the raw tables; with ``out`` every result is written below it.

    A job is a number of ``STEPS``; ``rebuild_tables`` runs single steps instead.
    """
    steps = [s for s in STEPS if not s.optional or all(r in raw for r in s.reads if r.endswith("_layer"))]
    jobs = [(s.job, s.name, s.run) for s in steps]
    if not out:
        return run_jobs(
            jobs, raw, run_from, run_till, lambda name, df: cut_lineage(df, name.replace("_", "-")) if name in SHARED else df
        )
    version = {"n": 0}

    def save(name: str, df: DataFrame) -> DataFrame:
        # A table may be extended by a later job that still reads it: new folder per write.
        version["n"] += 1
        return rebuild(df, f"{out.rstrip('/')}/{version['n']:02d}-{name}")

    # Every result lies below ``out``: what the jobs wrote for themselves can go.
    with Scratch(next(iter(raw.values())).sparkSession):
        return run_jobs(jobs, raw, run_from, run_till, save)


def rebuild_tables(
    raw: Tables, out: str, wanted: list[str] | None = None, versions: dict[str, str] | None = None, again: tuple[str, ...] = ()
) -> Tables:
    """Bring the wanted tables (all, if none are named) below ``out`` up to date: see ``operators.steps``."""
    # Steps that need raw tables which are not there are left out, unless a wanted table asks for them.
    have, steps = set(raw), []
    for s in STEPS:
        if have.issuperset(s.reads):
            have |= set(s.writes)
            steps.append(s)
    with Scratch(next(iter(raw.values())).sparkSession):
        return run_steps(steps, raw, out, versions, wanted, again)
