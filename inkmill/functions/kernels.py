"""NumPy image kernels (IMG1-IMG13, IMG16, WIN6, FLT4, PRJ3, PRJ6). Images are uint8, 255 is paper."""

from __future__ import annotations

import numpy as np


def gray(image: np.ndarray) -> np.ndarray:
    """IMG1: luma of a BGR image; gray images pass."""
    if image.ndim == 2:
        return image
    if image.shape[2] == 1:
        return image[:, :, 0]
    return np.rint(image[:, :, :3] @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)


def swap_channels(image: np.ndarray) -> np.ndarray:
    """IMG1: BGR to RGB and back."""
    return image[:, :, ::-1]


def smooth(image: np.ndarray) -> np.ndarray:
    """A 3 x 3 Gaussian (1 2 1) with mirrored borders, rounded."""
    x = np.pad(image.astype(np.int32), 1, mode="reflect") if min(image.shape) > 1 else np.pad(image.astype(np.int32), 1, mode="edge")
    x = x[:-2] + 2 * x[1:-1] + x[2:]
    return ((x[:, :-2] + 2 * x[:, 1:-1] + x[:, 2:] + 8) >> 4).astype(np.uint8)


def otsu(image: np.ndarray) -> int:
    """The level whose two sides have the greatest variance between them; the lowest of equal ones."""
    count = np.bincount(image.ravel(), minlength=256).astype(np.float64)
    below, total = np.cumsum(count), count.sum()
    moment = np.cumsum(count * np.arange(256))
    ok = (below > 0) & (below < total)
    between = np.zeros(256)
    between[ok] = (moment[-1] * below[ok] / total - moment[ok]) ** 2 / (below[ok] * (total - below[ok]))
    return int(np.argmax(between))


def binarize(image: np.ndarray) -> np.ndarray:
    """IMG2: smoothed, split by Otsu's level, ink as 255."""
    flat = smooth(gray(image))
    return np.where(flat > otsu(flat), 0, 255).astype(np.uint8)


def components(ink: np.ndarray) -> np.ndarray:
    """IMG7: 8-connected components of non-zero pixels: rows of x, y, width, height, area, mean y, in scan order.

    Horizontal runs are the nodes; runs of neighbouring rows that touch, corners
    included, are united.
    """
    height, width = ink.shape
    edge = np.diff(np.pad((ink > 0).astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    stop = np.nonzero(edge == -1)[1]
    root = np.arange(len(row))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    first = np.searchsorted(row, np.arange(height + 1))
    for y in range(1, height):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if start[i] <= stop[j] and start[j] <= stop[i]:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
            if stop[i] <= stop[j]:
                i += 1
            else:
                j += 1
    label = np.array([find(k) for k in range(len(row))], dtype=np.int64)
    heads, of = np.unique(label, return_inverse=True)
    n = len(heads)
    x1, x2, y1, y2 = np.full(n, width), np.zeros(n, int), np.full(n, height), np.zeros(n, int)
    np.minimum.at(x1, of, start)
    np.maximum.at(x2, of, stop)
    np.minimum.at(y1, of, row)
    np.maximum.at(y2, of, row + 1)
    area = np.bincount(of, stop - start, n)
    mean = np.bincount(of, (stop - start) * row, n) / np.maximum(area, 1)
    return np.column_stack([x1, y1, x2 - x1, y2 - y1, area, mean]) if n else np.empty((0, 6))


def ink_ratio(image: np.ndarray, level: int = 245) -> float:
    """PRJ3: share of pixels darker than ``level``."""
    return float((gray(image) < level).mean())


def direction(image: np.ndarray) -> str:
    """PRJ6: rtl if the ink's mean x lies right of the middle; a blank page is ltr."""
    flat = gray(image)
    columns = np.nonzero(flat <= otsu(flat))[1] if flat.min() < flat.max() else np.empty(0)
    return "rtl" if len(columns) and columns.mean() > flat.shape[1] / 2 else "ltr"


def apply_mask(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """IMG6: white where the mask is 0."""
    shown = mask != 0
    return np.where(shown if image.ndim == 2 else shown[:, :, None], image, 255).astype(np.uint8)


def row_bands(active: np.ndarray, least: int = 1) -> list[tuple[int, int]]:
    """WIN3: half-open runs of active rows."""
    edge = np.diff(np.concatenate([[0], active.astype(np.int8), [0]]))
    return [(a, b) for a, b in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist(), strict=True) if b - a >= least]


def text_mask(image: np.ndarray) -> np.ndarray:
    """IMG5, AGG12, FLT11, FLT12: 255 on probable notation rows, padded, and 0 elsewhere."""
    ink = binarize(image)
    height, width = ink.shape
    parts = components(ink)
    parts = parts[parts[:, 4] >= 6]
    least, low = max(18, int(width * 0.012)), max(10, int(height * 0.025))
    long = (parts[:, 2] >= least) & (parts[:, 3] <= low) & (parts[:, 2] >= 3 * parts[:, 3])
    active = np.zeros(height, bool)
    for y, h in parts[long][:, [1, 3]].astype(int):
        active[y : y + h] = True
    rows = []
    for a, b in row_bands(active):
        near = (parts[:, 1] + parts[:, 3] >= max(0, a - low)) & (parts[:, 1] <= min(height, b + low))
        n, k, wide = int(near.sum()), int((near & long).sum()), float(parts[near & long][:, 2].sum())
        if n <= 85 and ((k >= 8 and wide >= 300) or (k >= 3 and wide >= 150 and n <= 75)):
            rows.append((a, b, k, wide))
    mask = np.zeros(ink.shape, np.uint8)
    if len(rows) >= 2 or any(k >= 8 and wide >= 12 * least for _, _, k, wide in rows):
        pad = max(8, min(40, int(height * 0.008)))
        for a, b, _, _ in rows:
            mask[max(0, a - pad) : b + pad] = 255
    return mask


def crop_to_ink(image: np.ndarray) -> np.ndarray | None:
    """IMG10: the part that holds pixels under 128; None for a blank image."""
    rows, columns = np.nonzero((image < 128).any(1))[0], np.nonzero((image < 128).any(0))[0]
    return image[rows[0] : rows[-1] + 1, columns[0] : columns[-1] + 1] if len(rows) else None


def _shares(old: int, new: int) -> np.ndarray:
    """How much of each old cell each new cell covers, rows summing to 1."""
    edges = np.arange(new + 1) * (old / new)
    cells = np.arange(old)
    cover = np.minimum(edges[1:, None], cells + 1) - np.maximum(edges[:-1, None], cells)
    cover = np.clip(cover, 0, None)
    return cover / cover.sum(1, keepdims=True)


def resample(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area-weighted resampling."""
    return np.rint(_shares(image.shape[0], height) @ image.astype(np.float64) @ _shares(image.shape[1], width).T).astype(np.uint8)


def normal_shape(image: np.ndarray, canvas: int = 48) -> np.ndarray | None:
    """IMG10: ink cropped, scaled to the canvas by its longer side, split at 127, centred; None for a blank image."""
    crop = crop_to_ink(image)
    if crop is None:
        return None
    scale = canvas / max(crop.shape)
    h, w = (max(1, min(canvas, round(s * scale))) for s in crop.shape)
    small = np.where(resample(crop, h, w) > 127, 255, 0).astype(np.uint8)
    out = np.full((canvas, canvas), 255, np.uint8)
    y, x = (canvas - h) // 2, (canvas - w) // 2
    out[y : y + h, x : x + w] = small
    return out


def similarity(a: np.ndarray, b: np.ndarray, *, mirror: bool = False) -> float:
    """IMG11: Pearson correlation of ink, 0 without spread; with ``mirror`` the better of b and b flipped."""

    def r(p: np.ndarray, q: np.ndarray) -> float:
        p, q = (255.0 - p).ravel() / 255, (255.0 - q).ravel() / 255
        return 0.0 if min(p.std(), q.std()) < 1e-6 else float(np.corrcoef(p, q)[0, 1])

    return max(r(a, b), r(a, b[:, ::-1])) if mirror else r(a, b)


def centre_rows(image: np.ndarray, keep: float = 0.62) -> np.ndarray:
    """IMG16: the middle share of the rows."""
    margin = max(0, round(len(image) * (1 - keep) / 2))
    return image[margin : len(image) - margin]


def gradient(image: np.ndarray) -> np.ndarray:
    """IMG12: 3 x 3 Sobel magnitude of the ink, scaled to 255 and truncated."""
    x = np.pad(255.0 - image, 1, mode="reflect" if min(image.shape) > 1 else "edge")
    down = x[:-2] + 2 * x[1:-1] + x[2:]
    across = x[:, :-2] + 2 * x[:, 1:-1] + x[:, 2:]
    size = np.hypot(down[:, 2:] - down[:, :-2], across[2:] - across[:-2])
    return (size * (255 / size.max()) if size.max() > 0 else size).astype(np.uint8)


def correlation(page: np.ndarray, template: np.ndarray) -> np.ndarray:
    """IMG13: normalised cross-correlation at every placement; 0 where the page or the template is flat."""
    h, w = template.shape
    t = template - template.mean()
    p = page.astype(np.float64)
    shape = [1 << int(n - 1).bit_length() for n in (page.shape[0] + h, page.shape[1] + w)]
    top = np.fft.irfft2(np.fft.rfft2(p - p.mean(), shape) * np.conj(np.fft.rfft2(t, shape)), shape)[: page.shape[0] - h + 1, : page.shape[1] - w + 1]

    def window(x: np.ndarray) -> np.ndarray:
        c = np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        return c[h:, w:] - c[:-h, w:] - c[h:, :-w] + c[:-h, :-w]

    spread = np.maximum(window(p * p) - window(p) ** 2 / (h * w), 0)
    norm = np.sqrt(spread * (t * t).sum())
    return np.where(norm > 1e-6, top / np.where(norm > 1e-6, norm, 1), 0.0)


def peaks(score: np.ndarray, kernel: int) -> np.ndarray:
    """WIN6: where a score is the largest of its kernel x kernel neighbourhood; all of a plateau."""
    r = kernel // 2
    best = np.pad(score, r, constant_values=-np.inf)
    best = np.lib.stride_tricks.sliding_window_view(best, kernel, axis=0).max(-1)
    best = np.lib.stride_tricks.sliding_window_view(best, kernel, axis=1).max(-1)
    return score == best


def find_template(page: np.ndarray, template: np.ndarray, threshold: float, *, only_peaks: bool = True) -> list[tuple[int, int, int, int, float]]:
    """IMG13: placements (x, y, w, h, score) at or over the threshold; none if the template is larger than the page."""
    if template.shape[0] > page.shape[0] or template.shape[1] > page.shape[1]:
        return []
    score = correlation(page, template)
    hit = score >= threshold
    if only_peaks and hit.any():
        hit &= peaks(score, max(3, min(template.shape) // 3) | 1)
    h, w = template.shape
    return [(int(x), int(y), w, h, float(score[y, x])) for y, x in zip(*np.nonzero(hit), strict=True)]


def template_metrics(template: np.ndarray) -> tuple[int, float, float, int]:
    """FLT4: area, ink share, spread of the rows' ink shares, rows with ink."""
    ink = template == 0
    return template.size, float(ink.mean()), float(ink.mean(1).std()), int(ink.any(1).sum())


def tilt(image: np.ndarray) -> float:
    """IMG3: the angle in degrees (-45 to 45) of the smallest rectangle around the ink; 0 for a blank page."""
    y, x = np.nonzero(binarize(image))
    if not len(x):
        return 0.0
    points = np.unique(np.column_stack([x, y]).astype(np.float64), axis=0)

    def chain(pts) -> list:
        out: list = []
        for p in pts:
            while len(out) > 1 and (out[-1] - out[-2])[0] * (p - out[-2])[1] <= (out[-1] - out[-2])[1] * (p - out[-2])[0]:
                out.pop()
            out.append(p)
        return out[:-1]

    hull = np.array(chain(points) + chain(points[::-1])) if len(points) > 2 else points
    side = np.roll(hull, -1, axis=0) - hull
    best, angle = np.inf, 0.0
    for dx, dy in side:
        a = np.arctan2(dy, dx)
        turn = np.array([[np.cos(a), np.sin(a)], [-np.sin(a), np.cos(a)]])
        area = np.ptp(hull @ turn.T, axis=0).prod()
        if area < best - 1e-9:
            best, angle = area, np.degrees(a)
    return float((angle + 45) % 90 - 45)


def deskew(image: np.ndarray, most: float = 8.0) -> np.ndarray:
    """IMG3: the page turned upright about its middle, white outside; unchanged if blank, straight or tilted by more than ``most``."""
    angle = tilt(image)
    if angle == 0 or abs(angle) > most:
        return image.copy()
    h, w = image.shape[:2]
    a, cy, cx = np.radians(angle), h // 2, w // 2
    y, x = np.mgrid[:h, :w]
    sx = np.cos(a) * (x - cx) - np.sin(a) * (y - cy) + cx
    sy = np.sin(a) * (x - cx) + np.cos(a) * (y - cy) + cy
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    out = np.zeros(image.shape, np.float64)
    for dy in (0, 1):
        for dx in (0, 1):
            px, py = x0 + dx, y0 + dy
            inside = (px >= 0) & (px < w) & (py >= 0) & (py < h)
            value = np.where(inside if image.ndim == 2 else inside[:, :, None], image[np.clip(py, 0, h - 1), np.clip(px, 0, w - 1)], 255.0)
            share = (1 - np.abs(sx - px)) * (1 - np.abs(sy - py))
            out += value * (share if image.ndim == 2 else share[:, :, None])
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def dewarp(image: np.ndarray) -> np.ndarray:
    """IMG4: geometry is left as it is."""
    return image.copy()
