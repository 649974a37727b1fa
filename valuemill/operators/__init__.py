from valuemill.operators.encode import OneHotDropFirst, OneHotDropFirstModel
from valuemill.operators.impute import IterativeImputer, IterativeImputerModel, mean_imputer_model
from valuemill.operators.metrics import champion_challenger, neg_mse, regression_metrics
from valuemill.operators.relational import (best_by_mean, dedupe, preview, shape, slice_rows, top_n,
                                            union_by_name)
from valuemill.operators.scale import PopulationStandardScaler, PopulationStandardScalerModel
from valuemill.operators.split import fold_column, hash_split, train_test, with_folds
from valuemill.operators.stages import (ColumnDropper, DigitsToNumber, HalfEvenRounder, MileageConverter,
                                        NameSplitter, TorqueStandardizer, ValueMapper)
from valuemill.operators.store import last_wins, lookup_miss, lookup_or_score, upsert
from valuemill.operators.validate import null_profile, split_valid
from valuemill.operators.validate import validate as validate_rows

__all__ = [
    "OneHotDropFirst", "OneHotDropFirstModel", "IterativeImputer", "IterativeImputerModel",
    "mean_imputer_model", "champion_challenger", "neg_mse", "regression_metrics", "best_by_mean",
    "dedupe", "preview", "shape", "slice_rows", "top_n", "union_by_name", "PopulationStandardScaler",
    "PopulationStandardScalerModel", "fold_column", "hash_split", "train_test", "with_folds",
    "ColumnDropper", "DigitsToNumber", "HalfEvenRounder", "MileageConverter", "NameSplitter",
    "TorqueStandardizer", "ValueMapper", "last_wins", "lookup_miss", "lookup_or_score", "upsert",
    "null_profile", "split_valid", "validate_rows",
]
