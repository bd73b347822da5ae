from tallyweave.plans.establishments import clean_establishments
from tallyweave.plans.household import HouseholdWeights, prepare_household, weight_household
from tallyweave.plans.individuals import prepare_individuals, transfer_individual_weights
from tallyweave.plans.partials import PartialState, build_state, load_state, merge_states, save_state, weigh_state
from tallyweave.plans.rollup import roll_up, stack_finals
from tallyweave.plans.runs import control_period, run_establishments, run_individual, run_ingest, run_monthly, run_roll_up, run_running_roll_up

__all__ = [
    "HouseholdWeights",
    "PartialState",
    "build_state",
    "clean_establishments",
    "control_period",
    "load_state",
    "merge_states",
    "prepare_household",
    "prepare_individuals",
    "roll_up",
    "run_establishments",
    "run_individual",
    "run_ingest",
    "run_monthly",
    "run_roll_up",
    "run_running_roll_up",
    "save_state",
    "stack_finals",
    "transfer_individual_weights",
    "weigh_state",
    "weight_household",
]
