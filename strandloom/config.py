"""Engine configuration: one frozen value object with the defaults that the stages run with."""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import Any, Literal


def as_bool(value: Any) -> bool:
    """A boolean as is; of anything else, whether its text is true, yes or 1."""
    return value if isinstance(value, bool) else str(value).strip().lower() in ("true", "yes", "1")


#: Keys of a workflow's configuration file and the parameters that they set.
FILE_KEYS = {
    "remove_monoexons_without_cage_support": "filter_monoexon_tss",
    "remove_monoexon_premRNA_fragments": "filter_premrna",
    "remove_isoforms_with_noncanonical_splice_junctions": "filter_noncanonical",
    "remove_isoforms_with_template_switching_artifacts": "filter_rt_switching",
    "remove_isoforms_with_antisense_perfect_splicematch": "filter_antisense",
    "remove_isoforms_fully_contained_in_repeats": "filter_repeats",
    "remove_isoforms_overlapping_PAR_regions": "filter_par",
    "remove_isoforms_not_meeting_TPM_threshold": "filter_tpm",
    "remove_isoforms_with_mismapped_segdup_exons": "filter_segdup",
    "filt_monoexon_tss_maxdist_bp": "tss_max_distance",
    "filt_monoexon_min_intron_ovlp_bp": "premrna_min_intron_overlap",
    "filt_rmsk_min_ovlp_fract": "repeat_min_overlap_fraction",
    "filt_par_min_ovlp_fract": "par_min_overlap_fraction",
    "filt_tpm_min_count": "tpm_min",
    "filt_tpm_min_samples": "tpm_min_samples",
    "consolidate_protect_window": "protect_window",
    "consolidate_round_mode": "rounding",
    "consolidate_merge_min_frac": "merge_min_frac",
    "consolidate_merge_min_samples": "merge_min_samples",
    "prune_low_expressed_isoforms_retain_pct": "retain_locus_pct",
    "prune_low_expressed_isforms_match_mode": "match_mode",
    "prune_low_expressed_isforms_min_samples": "min_support_samples",
    "max_chrM_reads": "chrm_cap",
    "varscan_min_coverage": "variant_min_coverage",
    "varscan_min_reads2": "variant_min_reads",
}


@dataclass(frozen=True)
class EngineConfig:
    # isoform filters
    filter_monoexon_tss: bool = True
    filter_premrna: bool = True
    filter_noncanonical: bool = True
    filter_rt_switching: bool = True
    filter_antisense: bool = True
    filter_repeats: bool = True
    filter_par: bool = True
    filter_tpm: bool = True
    filter_segdup: bool = True
    tss_max_distance: int = 10
    premrna_min_intron_overlap: int = 10
    allowed_motifs: tuple[str, ...] = ("GTAG", "GCAG", "ATAC")
    rt_min_match: int = 8
    rt_wiggle: int = 1
    rt_allow_mismatch: bool = False
    repeat_min_overlap_fraction: float = 0.9
    par_min_overlap_fraction: float = 0.0
    tpm_min: float = 0.5
    tpm_min_samples: int = 3
    segdup_levels: tuple[int, ...] = (1, 2, 3, 4)
    segdup_exon_fraction: float = 0.9
    segdup_min_intron: int = 100_000
    antisense_mode: Literal["compat", "intended"] = "compat"
    strict_compat: bool = True
    # consolidation
    terminal_only: bool = True
    minimal_superset: bool = True
    proportional: bool = True
    merge_min_frac: float | None = 0.1
    merge_min_samples: int = 2
    protect_window: int = 50
    rounding: Literal["none", "nearest", "floor", "ceil"] = "nearest"
    # pruning
    match_mode: Literal["any_shared", "subset", "jaccard", "bridge_safe", "exact"] = "any_shared"
    min_shared: int = 1
    min_jaccard: float = 0.5
    bridge_strong: int = 2
    bridge_weak_jaccard: float = 0.15
    retain_top_pct: float = 98.0
    score: Literal["sum", "max", "mean"] = "sum"
    sample_support: bool = True
    sample_min_rel_expr: float = 0.0
    retain_locus_pct: float | None = 97.0
    min_support_samples: int = 2
    min_keep: int = 1
    # reads and reports
    chrm_cap: int = 50_000
    chrm_seed: int = 4232
    variant_min_coverage: int = 20
    variant_min_reads: int = 4
    hist_bin: int = 200
    hist_step: int = 10
    hist_method: Literal["sum", "mean", "median"] = "median"
    pivot_agg: Literal["first", "sum", "mean"] = "first"

    @classmethod
    def from_mapping(cls, given: dict[str, Any]) -> EngineConfig:
        """From loose values (of YAML or the like): booleans by ``as_bool``, tuples from lists; unknown keys are errors."""
        known = {f.name: f for f in fields(cls)}
        if unknown := sorted(set(given) - set(known)):
            raise KeyError(f"unknown keys: {', '.join(unknown)}")
        base = cls()
        return cls(**{k: as_bool(v) if isinstance(getattr(base, k), bool) else tuple(v) if isinstance(v, list) else v for k, v in given.items()})

    @classmethod
    def from_files(cls, *paths: str) -> EngineConfig:
        """From YAML files, later ones over earlier ones. Keys of FILE_KEYS, or parameters by name, are read; others (paths, other steps') are passed over."""
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML needs PyYAML; from_mapping takes a mapping") from e
        names, given = {f.name for f in fields(cls)}, {}
        for path in paths:
            with open(path, encoding="utf-8") as f:
                held = yaml.safe_load(f) or {}
            given |= {FILE_KEYS.get(k, k): v for k, v in held.items() if FILE_KEYS.get(k, k) in names}
        return cls.from_mapping(given)
