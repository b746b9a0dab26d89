"""Settings, their history, and command lines."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

log = logging.getLogger(__name__)

# Names of the choices that the command lines take.
CROPS = ("interactiveCrop", "autoCrop", "noCrop", "dearray", "plate")
CYTO_METHODS = ("hybrid", "distanceTransform", "bwdistanceTransform", "ring")
NUCLEI_FILTERS = ("IntPM", "LoG", "Int", "none")
NUCLEI_REGIONS = ("watershedContourDist", "watershedContourInt", "watershedBWDist", "dilation", "localThreshold", "localMax", "bypass", "pixellevel")
#: Names of one and the same flooding mode.
FLOODING = NUCLEI_REGIONS[:4]
LOCAL = ("localThreshold", "localMax")
# Units a pixel size can have.
UNITS = ("Ym", "Zm", "Em", "Pm", "Tm", "Gm", "Mm", "km", "hm", "dam", "m", "dm", "cm", "mm", "µm", "nm", "pm", "fm", "am", "zm", "ym", "Å", "thou", "li", "in", "ft", "yd", "mi", "ua", "ly", "pc", "pt", "pixel", "reference frame")


@dataclass(frozen=True)
class SegmentConfig:
    """The whole-image pipeline's settings; channels are 1-based."""

    prob_map_chan: int = -1
    crop: str = "noCrop"
    rectangle: tuple[int, int, int, int] | None = None
    cyto_method: str = "distanceTransform"
    nuclei_filter: str = "IntPM"
    nuclei_region: str = "watershedContourInt"
    pixel_threshold: float = -1
    segment_cytoplasm: bool = False
    cyto_dilation: int = 5
    log_sigma: tuple[float, float] = (3, 60)
    cyto_chans: tuple[int, ...] = (2,)
    pixel_chans: tuple[int, ...] = (2,)
    tissue_chans: tuple[int, ...] = (1,)
    puncta_chans: tuple[int, ...] = (0,)
    puncta_sigma: tuple[float, ...] = (0,)
    puncta_sd: tuple[float, ...] = (4,)
    save_mask: bool = True
    save_fig: bool = True
    #: Use the first marker's threshold for all of them.
    reuse_first_threshold: bool = False
    #: Keep ring masks within the tissue.
    ring_in_tissue: bool = False

    def __post_init__(self) -> None:
        for value, known in ((self.crop, CROPS), (self.cyto_method, CYTO_METHODS), (self.nuclei_filter, NUCLEI_FILTERS), (self.nuclei_region, NUCLEI_REGIONS)):
            if value not in known:
                raise ValueError(f"{value} is not one of {known}")
        if len(self.log_sigma) != 2:
            raise ValueError("two diameters are needed")
        if self.crop == "interactiveCrop" and self.rectangle is None:
            raise ValueError("give the rectangle; there is no window to draw it in")
        if self.nuclei_filter == "LoG" or self.cyto_method == "bwdistanceTransform":
            raise ValueError("this choice has no defined result")

    def puncta(self) -> list[tuple[int, float, float]]:
        """(channel, sigma, SD); single values hold for all channels; none if a channel is 0."""
        if min(self.puncta_chans) < 1:
            return []
        n = len(self.puncta_chans)
        spread = lambda xs: list(xs) * n if len(xs) == 1 else list(xs)
        sigma, sd = spread(self.puncta_sigma), spread(self.puncta_sd)
        if len(sigma) != n or len(sd) != n:
            raise ValueError("give one sigma and SD, or one for each channel")
        return list(zip(self.puncta_chans, sigma, sd, strict=True))


@dataclass(frozen=True)
class LargeConfig:
    """The out-of-core chain's settings."""

    h: float = 0.01
    sigma: float = 1.0
    footprint_size: int = 3
    overlap_size: int = 128
    mean_intensity_min: float = 128
    area_min: float = 10
    area_max: float = 500
    expand_size: int = 0
    pixel_size: float | None = None


@dataclass
class History:
    """Settings by number; a new number only for a change."""

    current: LargeConfig
    entries: dict[int, LargeConfig] = field(default_factory=dict)
    trials: list[tuple[LargeConfig, object]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.update()

    def update(self, **changes: object) -> int:
        self.current = replace(self.current, **changes)
        last = max(self.entries, default=-1)
        if last < 0 or self.entries[last] != self.current:
            last += 1
            self.entries[last] = self.current
        return last

    def use(self, number: int) -> LargeConfig:
        self.current = self.entries[number]
        self.update()
        return self.current

    @contextmanager
    def trial(self, chain: Callable[[], object]) -> Iterator[object]:
        """Run a chain on other inputs and note what it gave under which settings."""
        try:
            out = chain()
        except Exception:
            log.exception("the trial failed")
            out = None
        self.trials.append((self.current, out))
        yield out


class _Ignored(argparse.Action):
    def __call__(self, parser, namespace, values, option_string=None) -> None:
        log.warning("%s is accepted but has no effect", option_string)


def _segment_options(parser: argparse.ArgumentParser) -> None:
    add = parser.add_argument
    for name in ("--imagePath", "--outputPath", "--dearrayPath", "--maskPath"):
        add(name)
    for name in ("--contoursClassProbPath", "--nucleiClassProbPath", "--stackProbPath"):
        add(name, default="")
    add("--probMapChan", type=int, default=-1)
    add("--mask", choices=["TMA", "tissue", "none"], default="tissue")
    add("--crop", choices=CROPS, default="noCrop")
    add("--cytoMethod", choices=CYTO_METHODS, default="distanceTransform")
    add("--nucleiFilter", choices=NUCLEI_FILTERS, default="IntPM")
    add("--nucleiRegion", choices=NUCLEI_REGIONS, default="watershedContourInt")
    add("--pixelThreshold", type=float, default=-1)
    add("--segmentCytoplasm", choices=["segmentCytoplasm", "ignoreCytoplasm"], default="ignoreCytoplasm")
    add("--cytoDilation", type=int, default=5)
    for name, kind, default in (("--logSigma", int, [3, 60]), ("--CytoMaskChan", int, [2]), ("--pixelMaskChan", int, [2]), ("--TissueMaskChan", int, [0]), ("--detectPuncta", int, [0]), ("--punctaSigma", float, [0]), ("--punctaSD", float, [4])):
        add(name, type=kind, nargs="+", default=default)
    add("--saveMask", action="store_false")
    add("--saveFig", action="store_false")


def segment_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Segment cells of a raster")
    _segment_options(parser)
    parser.add_argument("--rectangle", type=int, nargs=4, help="y, x, height and width for interactiveCrop")
    return parser


def parse_segment(argv: list[str]) -> tuple[argparse.Namespace, SegmentConfig]:
    a = segment_parser().parse_args(argv)
    nuclear = max(a.probMapChan, 1)
    # without tissue channels the cytoplasm's stand for them; the nuclear channel always goes along
    tissue = tuple(dict.fromkeys((*(a.CytoMaskChan if a.TissueMaskChan == [0] else a.TissueMaskChan), nuclear)))
    return a, SegmentConfig(
        a.probMapChan, a.crop, tuple(a.rectangle) if a.rectangle else None, a.cytoMethod, a.nucleiFilter, a.nucleiRegion, a.pixelThreshold, a.segmentCytoplasm == "segmentCytoplasm", a.cytoDilation,
        tuple(a.logSigma), tuple(a.CytoMaskChan), tuple(a.pixelMaskChan), tissue, tuple(a.detectPuncta), tuple(a.punctaSigma), tuple(a.punctaSD), a.saveMask, a.saveFig,
    )


def large_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Segment a large raster tile by tile")
    parser.add_argument("-i", dest="input", required=True)
    parser.add_argument("-o", dest="output", required=True)
    d = LargeConfig()
    for name, kind in (("gaussian-sigma", float), ("maxima-h", float), ("maxima-footprint-size", int), ("overlap-size", int), ("mean-intensity-min", float), ("area-min", float), ("area-max", float), ("expand-size", int)):
        key = {"gaussian-sigma": "sigma", "maxima-h": "h", "maxima-footprint-size": "footprint_size"}.get(name, name.replace("-", "_"))
        parser.add_argument(f"--{name}", dest=key, type=kind, default=getattr(d, key))
    parser.add_argument("--mcmicro", action="store_true")
    parser.add_argument("--pixel-size", type=float)
    return parser


def wrapper_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Segment a large raster and show the result over image channels")
    parser.add_argument("--imagePath", required=True)
    parser.add_argument("--stackProbPath", required=True)
    parser.add_argument("--probMapChan", type=int, nargs="+", default=[1])
    parser.add_argument("--outputPath", default=".")
    parser.add_argument("--pixelSize", type=float)
    return parser


def accept_and_warn(parser: argparse.ArgumentParser) -> list[str]:
    """Let a parser take the whole-image options that it lacks, with a warning each; returns them."""
    lacking = sorted(set(segment_parser()._option_string_actions) - set(parser._option_string_actions))
    for name in lacking:
        parser.add_argument(name, action=_Ignored, default=argparse.SUPPRESS, nargs="*", metavar="", help="IGNORED")
    return lacking


def pixel_size(given: float | None, found: float | None, default: float | None = 1.0) -> float:
    """The caller's, the file's, or the default; ValueError without any."""
    for value in (given, found, default):
        if value is not None:
            return value
    raise ValueError("the pixel size is unknown")


def channel_from_name(name: str) -> int | None:
    """The 1-based channel that a probability map's file name ends in, as in ``..._ContoursPM_3.tif``."""
    import re

    m = re.search(r"ContoursPM_(\d+)", name)
    return int(m[1]) if m else None


def output_paths(folder: str, image: str, expand: int = 0) -> dict[str, str]:
    """Where the large chain writes its masks and QC image."""
    stem = image.rsplit("/", 1)[-1].split(".")[0]
    base = f"{folder.rstrip('/')}/{stem}"
    out = {"nuclei": f"{base}/nucleiRing.ome.tif", "qc": f"{base}/qc/nucleiRing-qc.ome.tif"}
    if expand:
        out |= {"cell": f"{base}/cellRing.ome.tif", "cyto": f"{base}/cytoRing.ome.tif", "expanded": f"{base}/nucleiRing-expanded_{expand}.ome.tif"}
    return out
