"""Settings of hit calling: fixed values of the presets, and rules that follow the number of rows."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class HitConfig:
    pseudo: float = 0.5
    lambda_neg: float = 0.5
    tau_neg: float = 0.0
    neg_strict: bool = False
    gate: str = "soft"
    most_q_bead: float | None = None
    most_q_bead_r2: float | None = None
    least_bead: float | None = 0.0
    least_bead_r2: float | None = None
    least_boost: float = 0.0
    pct_cut: float = 95.0
    least_w: float = 0.5
    least_r2: float = 0.0
    alpha_boost: float = 0.5
    beta_bead2: float = 0.0
    gamma_paired: float = 0.0
    lambda_var: float = 0.3
    centering: bool = False
    center_quantile: float = 0.5
    center_r2_most: float = 0.5
    most_centered: float | None = None
    least_avg_r1: float | None = 1.0
    most_sd_r1: float | None = None
    least_del2: float | None = 0.0
    least_paired: float | None = None
    most_q_paired: float | None = None
    least_z: float | None = None


# The presets' knobs.
_MEDIUM = {
    "neg_strict": True, "lambda_neg": 0.7, "tau_neg": 0.05, "gate": "soft", "most_q_bead": 0.10, "most_q_bead_r2": 0.10, "least_bead": 0.3, "least_bead_r2": 0.3,
    "centering": True, "center_quantile": 0.5, "center_r2_most": 0.6, "most_centered": 0.30, "alpha_boost": 0.6, "gamma_paired": 0.15,
}
_NEG_HEAVY = {
    "neg_strict": True, "lambda_neg": 1.0, "tau_neg": 0.1, "gate": "hard", "most_q_bead": 0.05, "most_q_bead_r2": 0.05, "least_bead": 0.5, "least_bead_r2": 0.5,
    "centering": True, "center_quantile": 0.5, "center_r2_most": 0.5, "most_centered": 0.20, "alpha_boost": 0.7, "gamma_paired": 0.2,
}
_VERY_HARD = {
    "neg_strict": True, "lambda_neg": 1.2, "tau_neg": 0.0, "gate": "hard", "most_q_bead": 0.01, "most_q_bead_r2": 0.01, "least_bead": 1.0, "least_bead_r2": 1.0,
    "centering": True, "center_quantile": 0.4, "center_r2_most": 0.4, "most_centered": 0.10, "alpha_boost": 0.8, "gamma_paired": 0.3,
    "pct_cut": 97.0, "least_w": 0.6, "least_r2": 0.2,
}
PRESETS = {
    "balanced": {}, "lenient": {"lambda_neg": 0.3, "gate": "none"}, "medium": _MEDIUM, "neg_heavy": _NEG_HEAVY, "hard_filter": _NEG_HEAVY, "very_hard": _VERY_HARD,
}


def preset(name: str, **more) -> HitConfig:
    return replace(HitConfig(), **{**PRESETS[name], **more})


def fit_rows(rows: int) -> tuple[str, float, int]:
    """Mode, percent and cap of the rows that are fitted."""
    if rows <= 0:
        return "skip", 0.0, 0
    if rows < 1_000_000:
        return "full", 100.0, rows
    return ("top", 2.0, 200_000) if rows < 5_000_000 else ("top", 0.5, 500_000)


def prefilter_for(rows: int) -> tuple[float, int, int]:
    """Quantile of the control, least total and least control by the number of rows."""
    for least, values in ((50_000_000, (0.9, 5, 2)), (20_000_000, (0.85, 4, 2)), (5_000_000, (0.75, 3, 1)), (1_000_000, (0.5, 2, 1))):
        if rows >= least:
            return values
    return 0.0, 0, 0
