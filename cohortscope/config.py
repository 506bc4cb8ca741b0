"""What to evaluate: strata, covariates, gates. Everything here is small and lives on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from itertools import combinations

# The demographic columns a cohort is cut by.
STRATA = (
    "race",
    "ethnicity",
    "sex_at_birth",
    "ancestry_pred",
    "income_quartiles",
    "education",
    "gender",
    "age_quartiles",
)

# Answers that never form a group.
AMBIGUOUS = (
    "PMI: Prefer Not To Answer",
    "PMI: Skip",
    "I prefer not to answer",
    "None",
    "Intersex",
    "No matching concept",
    "None of these",
    "More than one population",
    "None Indicated",
    "other",
)

# Names of the three models fitted in every cell.
PRS_ONLY = "prs_only"
BOTH = "prs_and_covariates"
COVARIATES_ONLY = "covariates_only"
FORMULAS = (PRS_ONLY, BOTH, COVARIATES_ONLY)

# The two methods.
LINEAR = "linear"
LOGISTIC = "logistic"


@dataclass(frozen=True)
class StrataSet:
    """One stratum, or an allowed pair of strata; its cells are the groups seen in the data."""

    set_id: int
    one: str
    two: str | None
    use_sex: bool


@dataclass(frozen=True)
class EvalConfig:
    """Settings of an evaluation run. Gates are strict: a cell is reported when n > linear_min_n."""

    strata: tuple[str, ...] = STRATA
    # No pair is formed from two strata of the same family.
    families: tuple[tuple[str, ...], ...] = (
        ("gender", "sex_at_birth"),
        ("ancestry_pred", "race", "ethnicity"),
    )
    ambiguous: tuple[str, ...] = AMBIGUOUS
    covariates: tuple[str, ...] = (
        "age",
        "agesq",
        "sex_at_birth",
        *(f"pca_{i}" for i in range(1, 17)),
    )
    sex_covariate: str = "sex_at_birth"
    # A cell cut by a stratum whose name contains one of these does not use the sex covariate.
    sex_markers: tuple[str, ...] = ("sex", "gender")
    formulas: tuple[str, ...] = FORMULAS
    outcome_alias: dict[str, str] = field(default_factory=lambda: {"bmi": "obesity"})
    linear_min_n: int = 20
    linear_min_test: int = 0
    logistic_min_n: int = 20
    min_cases: int = 20
    suppress: int = 20
    suppress_all: bool = False
    test_fraction: float = 0.2
    inverse_penalty: float = 1.0
    # Newton passes at most. A model that needs more fails the run, or is marked if it is allowed to stay.
    max_iter: int = 1000
    keep_unconverged: bool = False
    tolerance: float = 1e-8
    holdout_seed: str = "42"
    # Texts of a demographics file that mean a missing value, besides an empty one.
    null_tokens: tuple[str, ...] = ("None", "NA")
    # Upper bound on the number of models iterated together; more are fitted in further rounds, some at a time.
    models_per_round: int = 50_000
    rounds_in_flight: int = 3
    # Largest number of distinct values ranked inside one task; larger groups are binned first.
    max_ranked: int = 50_000
    # Levels of a text covariate at most, each a column of the model. A request's sums per cell grow with
    # the square of the columns, so raise it only as far as the tasks' memory allows.
    max_levels: int = 1000

    def strata_sets(self) -> list[StrataSet]:
        pairs = [
            (a, b)
            for a, b in combinations(self.strata, 2)
            if not any(a in family and b in family for family in self.families)
        ]
        cuts = [(s, None) for s in self.strata] + pairs
        return [
            StrataSet(i, a, b, not any(m in name for name in (a, b or "") for m in self.sex_markers))
            for i, (a, b) in enumerate(cuts)
        ]

    @property
    def uses_sex(self) -> bool:
        return self.sex_covariate in self.covariates

    def with_(self, **changes) -> EvalConfig:
        return replace(self, **changes)

    @classmethod
    def legacy(cls) -> EvalConfig:
        """The older rules: gates of 100, no outcome alias, 100 passes; "other" and, in a file, "NA" are ordinary answers."""
        return cls(
            ambiguous=tuple(a for a in AMBIGUOUS if a != "other"),
            outcome_alias={},
            linear_min_n=99,
            linear_min_test=20,
            logistic_min_n=100,
            max_iter=100,
            null_tokens=(),
        )
