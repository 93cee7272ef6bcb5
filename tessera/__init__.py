"""tessera: table preparation, profiling, algebra and model scoring/training as
Spark DataFrame operators.

Every operator takes and returns DataFrames; fitted objects (scaler statistics,
dictionaries, imputer fill values, model parameters) are small tables or small
driver-side objects whose size is bounded by the number of features, categories
or parameters, never by the number of rows.
"""

from tessera.session import checkpoint_dir, get_session
from tessera.sources.footers import footer_profile
from tessera.sources.csv import make_csv, read_csv
from tessera.sources.model_io import load_model, save_model
from tessera.sources.preview import preview
from tessera.sources.scaler_io import load_scaler, save_scaler
from tessera.operators.profile import (describe_numeric, describe_string, mean_median, medians,
                                       row_count, squared_error, value_counts)
from tessera.operators.exact import exact_gram, exact_means, exact_squared_error
from tessera.operators.impute import fit_imputer
from tessera.operators.scale import fit_scaler, fit_scaler_array
from tessera.operators.encode import (category_key, fit_dictionaries, fit_dictionary, label_encode,
                                      numeric_key, one_hot, one_hot_encode)
from tessera.operators.dataset import Dataset, split_dataset, to_dataset, to_image_dataset
from tessera.operators.split import gather, shuffle_positions, split_labels, train_test_split, with_batches
from tessera.operators.model import AvgPool2D, Conv2D, Dense, Flatten, MaxPool2D, Sequential
from tessera.operators.score import predict
from tessera.operators.optim import new_optimizer
from tessera.operators.train import EarlyStopping, compile_model, evaluate, fit

__all__ = [
    "get_session", "checkpoint_dir", "read_csv", "make_csv", "preview", "save_model", "load_model",
    "save_scaler", "load_scaler", "describe_numeric", "describe_string", "mean_median", "medians",
    "row_count", "squared_error", "value_counts", "fit_imputer", "fit_scaler", "fit_scaler_array",
    "category_key", "numeric_key", "fit_dictionary", "fit_dictionaries", "label_encode", "one_hot",
    "one_hot_encode", "Dataset", "to_dataset", "to_image_dataset", "split_dataset", "train_test_split",
    "split_labels", "shuffle_positions", "with_batches", "gather", "Sequential", "Dense", "Conv2D",
    "MaxPool2D", "AvgPool2D", "Flatten", "predict", "new_optimizer", "compile_model", "fit", "evaluate",
    "EarlyStopping", "exact_means", "exact_squared_error", "exact_gram", "footer_profile",
]
