from gridops.functions.columns import (
    clamp,
    idiv,
    period_of_day,
    round_half_away,
    sunshine_state,
    surrogate_key,
)

__all__ = ["clamp", "idiv", "period_of_day", "round_half_away", "sunshine_state", "surrogate_key"]
