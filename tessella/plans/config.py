"""Run configuration: option tables, layered defaults, naming rules and the options dump.

Options are data. A configuration is resolved in layers: common and phase options, what the model changes, then what the
dataset mode (as it stands after the model's layer) changes; what the user gives always wins, unknown options raise.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

INF = float("inf")

#: Option tables (fixed values): name: default. A default of None marks a required option. Models have plain names here:
#: unpaired and paired stand for the two translation models.
COMMON: dict[str, Any] = {
    "dataroot": None, "name": "experiment_name", "checkpoints_dir": "./checkpoints",
    "model": "unpaired", "input_nc": 3, "output_nc": 3, "ngf": 64, "ndf": 64,
    "netD": "basic", "netG": "resnet_9blocks", "n_layers_D": 3, "norm": "instance",
    "init_type": "normal", "init_gain": 0.02, "no_dropout": False,
    "dataset_mode": "unaligned", "direction": "AtoB", "serial_batches": False, "num_threads": 4,
    "batch_size": 1, "load_size": 286, "crop_size": 256, "max_dataset_size": INF,
    "preprocess": "resize_and_crop", "no_flip": False, "display_winsize": 256,
    "epoch": "latest", "load_iter": 0, "verbose": False, "suffix": "",
    "use_wandb": False, "wandb_project_name": "image-translation",
}
TRAIN: dict[str, Any] = {
    "display_freq": 400, "update_html_freq": 1000, "print_freq": 100, "no_html": False,
    "save_latest_freq": 5000, "save_epoch_freq": 5, "save_by_iter": False, "continue_train": False,
    "epoch_count": 1, "phase": "train", "n_epochs": 100, "n_epochs_decay": 100,
    "beta1": 0.5, "lr": 0.0002, "gan_mode": "lsgan", "pool_size": 50,
    "lr_policy": "linear", "lr_decay_iters": 50,
}
TEST: dict[str, Any] = {"results_dir": "./results/", "aspect_ratio": 1.0, "phase": "test", "eval": False, "num_test": 50}
#: What models and dataset modes add or change: always, and in training only.
MODELS: dict[str, tuple[dict[str, Any], dict[str, Any]]] = {
    "unpaired": ({"no_dropout": True}, {"lambda_A": 10.0, "lambda_B": 10.0, "lambda_identity": 0.5}),
    "paired": ({"norm": "batch", "netG": "unet_256", "dataset_mode": "aligned"}, {"pool_size": 0, "gan_mode": "vanilla", "lambda_L1": 100.0}),
    "colorization": (
        {"norm": "batch", "netG": "unet_256", "dataset_mode": "colorization"},
        {"pool_size": 0, "gan_mode": "vanilla", "lambda_L1": 100.0},
    ),
    "test": ({"dataset_mode": "single", "model_suffix": ""}, {}),
    "template": ({"dataset_mode": "aligned"}, {"lambda_regression": 1.0}),
}
DATASETS: dict[str, dict[str, Any]] = {
    "aligned": {}, "unaligned": {}, "single": {},
    "colorization": {"input_nc": 1, "output_nc": 2, "direction": "AtoB"},
    "template": {"new_dataset_option": 2.0, "max_dataset_size": 10},
}
#: What a test run fixes, whatever was given.
TEST_FIXED: dict[str, Any] = {"num_threads": 0, "batch_size": 1, "serial_batches": True, "no_flip": True}


@dataclass(frozen=True)
class Config:
    """Resolved options and their defaults."""

    values: dict[str, Any]
    defaults: dict[str, Any]
    is_train: bool
    extra: dict[str, Any] = field(default_factory=dict)

    def __getattr__(self, name: str) -> Any:
        try:
            return self.__dict__["values"][name]
        except KeyError:
            raise AttributeError(name) from None


def resolve(user: dict[str, Any], is_train: bool = True, models=None, datasets=None) -> Config:
    """A configuration from the user's options. ``models`` / ``datasets`` extend the built-in layers."""
    models, datasets = MODELS | (models or {}), DATASETS | (datasets or {})
    defaults = COMMON | (TRAIN if is_train else TEST)
    if not is_train:
        defaults |= {"model": "test", "load_size": defaults["crop_size"]}
    model = user.get("model", defaults["model"])
    if model not in models:
        raise ValueError(f"no model named {model}")
    if model == "test" and is_train:
        raise ValueError("the test model cannot be trained")
    always, training = models[model]
    defaults = defaults | always | (training if is_train else {})
    mode = user.get("dataset_mode", defaults["dataset_mode"])
    if mode not in datasets:
        raise ValueError(f"no dataset named {mode}")
    defaults = defaults | datasets[mode]
    if unknown := sorted(set(user) - set(defaults)):
        raise ValueError(f"unknown options: {', '.join(unknown)}")
    values = defaults | user
    if missing := [k for k, v in values.items() if v is None]:
        raise ValueError(f"required options: {', '.join(missing)}")
    if values["suffix"]:
        values["name"] = values["name"] + "_" + values["suffix"].format(**values)
    if values["dataset_mode"] == "aligned" and values["load_size"] < values["crop_size"]:
        raise ValueError("load_size must not be below crop_size")
    return Config(values, defaults, is_train)


def from_arguments(arguments: list[str], is_train: bool = True, **layers) -> Config:
    """A configuration from command-line words: --name value, or --name alone for a switch."""
    known = COMMON | TRAIN | TEST
    for always, training in (MODELS | layers.get("models", {})).values():
        known = known | always | training
    for more in (DATASETS | layers.get("datasets", {})).values():
        known = known | more
    user: dict[str, Any] = {}
    words = iter(arguments)
    for word in words:
        name = word.removeprefix("--")
        if name == word or name not in known:
            raise ValueError(f"unknown option {word}")
        default = known[name]
        if default is False or default is True:
            user[name] = True
        else:
            text = next(words)
            kind = int if default == INF or isinstance(default, int) else float if isinstance(default, float) else str
            user[name] = kind(text)
    return resolve(user, is_train, **layers)


def test_run(config: Config) -> Config:
    return Config(config.values | TEST_FIXED, config.defaults, False)


def options_text(config: Config) -> str:
    """The options dump: sorted, aligned, changed options with their default."""
    lines = ["----------------- Options ---------------"]
    for k in sorted(config.values):
        v, d = config.values[k], config.defaults.get(k)
        lines.append(f"{k:>25}: {v!s:<30}" + ("" if v == d else f"\t[default: {d}]"))
    return "\n".join([*lines, "----------------- End -------------------"]) + "\n"


def options_file(config: Config) -> str:
    return f"{config.checkpoints_dir}/{config.name}/{config.phase}_opt.txt"


def checkpoint_name(epoch: str | int, network: str, load_iter: int = 0) -> str:
    return f"{f'iter_{load_iter}' if load_iter > 0 else epoch}_net_{network}.pth"


def results_folder(config: Config) -> str:
    at = f"{config.results_dir}/{config.name}/{config.phase}_{config.epoch}"
    return f"{at}_iter{config.load_iter}" if config.load_iter > 0 else at
