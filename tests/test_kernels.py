import numpy as np
import pytest

from inkmill.functions import kernels as k
from inkmill.sources.images import data_url, png


def paper(h, w):
    return np.full((h, w), 255, np.uint8)


def slow_components(ink):
    seen, out = np.zeros(ink.shape, bool), []
    for y, x in zip(*np.nonzero(ink), strict=True):
        if seen[y, x]:
            continue
        stack, cells = [(y, x)], []
        seen[y, x] = True
        while stack:
            a, b = stack.pop()
            cells.append((a, b))
            for p in range(a - 1, a + 2):
                for q in range(b - 1, b + 2):
                    if 0 <= p < ink.shape[0] and 0 <= q < ink.shape[1] and ink[p, q] and not seen[p, q]:
                        seen[p, q] = True
                        stack.append((p, q))
        ys, xs = zip(*cells, strict=True)
        out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(cells), sum(ys) / len(ys)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_components_against_flood_fill(seed):
    rng = np.random.default_rng(seed)
    ink = (rng.random((rng.integers(1, 30), rng.integers(1, 30))) < rng.choice([0.1, 0.4, 0.7])).astype(np.uint8)
    got = sorted(map(tuple, k.components(ink).tolist()))
    assert len(got) == len(slow_components(ink)) and np.allclose(got or [[]], slow_components(ink) or [[]])


def test_binarize():
    page = paper(20, 20)
    page[5:15, 5:15] = 0
    out = k.binarize(page)
    assert out[10, 10] == 255 and out[0, 0] == 0
    assert k.gray(np.dstack([page] * 3)).tolist() == page.tolist()
    assert k.swap_channels(np.array([[[1, 2, 3]]]))[0, 0].tolist() == [3, 2, 1]


def test_otsu_against_definition():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(60, 10, 500), rng.normal(180, 20, 700)]).clip(0, 255).astype(np.uint8)

    def between(t):
        a, b = x[x <= t].astype(float), x[x > t].astype(float)
        return len(a) * len(b) * (a.mean() - b.mean()) ** 2 if len(a) and len(b) else 0

    assert between(k.otsu(x)) == pytest.approx(max(between(t) for t in range(256)))


def test_text_mask_keeps_notation_rows():
    page = paper(120, 240)
    for y in (18, 80):
        for x in (20, 85, 150):
            page[y : y + 5, x : x + 55] = 0
    page[46:54, 25:36] = page[46:54, 45:56] = page[108:114, 25:36] = 0
    mask = k.text_mask(page)
    assert (mask[18:23] == 255).mean() > 0.9 and (mask[47:53] == 255).mean() < 0.2


def test_text_mask_of_prose_is_empty():
    page = paper(160, 240)
    for y in range(20, 121, 20):
        for x in range(20, 220, 18):
            page[y : y + 8, x : x + 8] = 0
        page[y + 5 : y + 7, 50:72] = 0
    assert not k.text_mask(page).any()


def test_apply_mask():
    mask = np.zeros((10, 10), np.uint8)
    mask[2:5] = 255
    out = k.apply_mask(np.zeros((10, 10, 3), np.uint8), mask)
    assert out[0].min() == 255 and out[3].max() == 0


def test_direction_and_ink():
    page = paper(40, 100)
    page[10:30, 70:95] = 0
    assert k.direction(page) == "rtl" and k.direction(page[:, ::-1]) == "ltr" and k.direction(paper(5, 5)) == "ltr"
    assert k.ink_ratio(page) == pytest.approx(500 / 4000)


def test_normal_shape_ignores_position():
    a, b = paper(40, 40), paper(40, 40)
    a[4:18, 7:18] = 0
    b[18:32, 22:33] = 0
    assert k.similarity(k.normal_shape(a, 24), k.normal_shape(b, 24)) > 0.999
    assert k.normal_shape(paper(9, 9)) is None and k.crop_to_ink(paper(3, 3)) is None


def test_mirrored_similarity():
    a = paper(24, 24)
    a[4:20, 5:9] = a[16:20, 5:18] = 0
    assert k.similarity(a, a[:, ::-1]) < 0.5 and k.similarity(a, a[:, ::-1], mirror=True) > 0.999
    assert k.similarity(a, paper(24, 24)) == 0


def test_correlation_against_definition():
    rng = np.random.default_rng(1)
    page, t = rng.integers(0, 256, (19, 23)).astype(np.uint8), rng.integers(0, 256, (5, 7)).astype(np.uint8)
    page[:8, :9] = 255
    got = k.correlation(page, t)
    for y in range(15):
        for x in range(17):
            w = page[y : y + 5, x : x + 7].astype(float)
            want = 0.0 if w.std() == 0 else np.corrcoef(w.ravel(), t.ravel())[0, 1]
            assert got[y, x] == pytest.approx(want, abs=1e-7)


def test_find_template_and_peaks():
    page, t = paper(60, 80), paper(10, 12)
    t[2:8, 3:5] = t[6:8, 3:10] = 0
    page[20:30, 30:42], page[40:50, 60:72] = t, t
    assert sorted(h[:2] for h in k.find_template(page, t, 0.95)) == [(30, 20), (60, 40)]
    assert k.find_template(page, paper(61, 5), 0.1) == []
    assert len(k.find_template(page, t, 0.5, only_peaks=False)) >= 2
    assert k.peaks(np.array([[1.0, 2.0, 2.0], [0.0, 0.0, 0.0]]), 3).tolist() == [[False, True, True], [False, False, False]]


def test_gradient_is_sobel():
    page = paper(7, 7)
    page[:, 4:] = 0
    g = k.gradient(page)
    assert g[3].tolist() == [0, 0, 0, 255, 255, 0, 0] and not k.gradient(paper(4, 4)).any()


def test_template_metrics_and_bands():
    t = paper(10, 10)
    t[2:5, 1:9] = 0
    area, ink, spread, rows = k.template_metrics(t)
    assert (area, rows) == (100, 3) and ink == pytest.approx(0.24) and spread == pytest.approx(np.std([0.8] * 3 + [0] * 7))
    assert k.row_bands(np.array([1, 1, 0, 1, 0, 1, 1, 1], bool), 2) == [(0, 2), (5, 8)]
    assert k.centre_rows(np.arange(50).reshape(50, 1)).ravel().tolist() == list(range(10, 40)) and len(k.centre_rows(t, 1.0)) == 10


def test_deskew_turns_small_tilts():
    page = paper(120, 160)
    y, x = np.mgrid[:120, :160]
    page[(np.abs((y - 60) - np.tan(np.radians(4)) * (x - 80)) < 10) & (np.abs(x - 80) < 55)] = 0
    assert abs(k.tilt(page)) > 2
    assert abs(k.tilt(k.deskew(page))) < 1.5
    assert (k.deskew(paper(9, 9)) == 255).all() and (k.dewarp(page) == page).all()


def test_resample_keeps_the_mean():
    x = np.arange(48, dtype=np.uint8).reshape(6, 8) * 5
    assert abs(k.resample(x, 3, 4).mean() - x.mean()) < 1 and k.resample(x, 6, 8).tolist() == x.tolist()


def test_png_reads_back(spark, tmp_path):
    page = np.arange(35, dtype=np.uint8).reshape(5, 7)
    (tmp_path / "p.png").write_bytes(png(page))
    r = spark.read.format("image").load(str(tmp_path)).select("image.*").first()
    assert (r.height, r.width, r.nChannels) == (5, 7, 1) and bytes(r.data) == page.tobytes()
    assert data_url(page).startswith("data:image/png;base64,iVBOR")
