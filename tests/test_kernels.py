import numpy as np
import pytest

from voxloom.kernels import basic, phasecorr, transforms
from voxloom.operators import fuse, illumination, layout, storage


def test_cosine_transform_is_orthonormal():
    a = np.random.default_rng(1).normal(size=(7, 9, 4))
    t = transforms.dct(a)
    assert np.isclose(np.linalg.norm(t), np.linalg.norm(a))
    assert np.allclose(transforms.dct(t, inverse=True), a)


def test_resize_keeps_constants_lines_and_corners():
    assert np.allclose(transforms.resized(np.full((4, 6), 3.0), (9, 5), 3), 3)
    line = np.arange(5.0)[:, None] * np.ones(3)
    assert np.allclose(transforms.resized(line, (9, 3))[:, 0], np.linspace(0, 4, 9))
    a = np.random.default_rng(2).normal(size=(5, 5))
    b = transforms.resized(a, (11, 11), 3)
    assert np.allclose(b[::10, ::10], a[::4, ::4])


def test_cubic_resizing_is_a_spline():
    x = np.linspace(0, np.pi, 9)
    fine = transforms.resized(np.cos(x), (65,), 3)  # mirrored at both ends, as the cosine is
    assert np.abs(fine - np.cos(np.linspace(0, np.pi, 65))).max() < 1e-3
    a = np.random.default_rng(8).normal(size=(6, 7))
    b = transforms.resized(a, (51, 61), 3)
    assert np.allclose(b[::10, ::10], a)
    d = np.diff(b[:, 0], 2)  # the second derivative has no jumps at the knots
    assert np.abs(np.diff(d)).max() < 3 * np.abs(d).max() / 10 + 1e-9


def test_otsu_splits_two_levels():
    assert 10 <= transforms.otsu(np.array([10.0] * 50 + [90.0] * 30)) < 90


def test_erosion_is_a_ball():
    m = np.ones((7, 7), bool)
    m[3, 3] = False
    assert (~transforms.eroded(m, 1)).sum() == 5


@pytest.mark.parametrize("shift", [(0, 0), (3, -2), (-4, 5)])
def test_phase_correlation_finds_the_shift(shift):
    big = np.random.default_rng(3).normal(size=(60, 60))
    a = big[10:42, 10:42]
    b = big[10 + shift[0] : 42 + shift[0], 10 + shift[1] : 42 + shift[1]]
    assert phasecorr.shift_between(a, b)[:2] == shift


def test_basic_fit_recovers_a_smooth_field():
    y, x = np.mgrid[:32, :32] / 31
    flat = 1 + 0.4 * (x - 0.5) - 0.3 * (y - 0.5) ** 2
    flat /= flat.mean()
    rng = np.random.default_rng(4)
    planes = np.stack([flat * b for b in rng.uniform(500, 900, 40)]) + rng.normal(0, 2, (40, 32, 32))
    for p in planes[::4]:
        p[5:9, 5:9] += 3000  # objects
    got, _, b = basic.fit_basic(planes)
    assert np.isclose(got.mean(), 1)
    assert np.abs(got - flat).max() < 0.05
    assert (b > 0).all()
    got, _, b = basic.fit_basic(planes, basic.BasicParams(approximate=True))
    assert np.isclose(got.mean(), 1) and np.abs(got - flat).max() < 0.1 and (b > 0).all()


def test_gains_by_component():
    g = illumination.solve_gains([(1, 2, 2.0), (2, 3, 2.0), (7, 8, 1.0)], [1, 2, 3, 5, 7, 8])
    assert np.allclose([g[1], g[2], g[3]], [1, 0.5, 0.25])
    assert g[5] == 1 and np.isclose(g[7], 1) and np.isclose(g[8], 1)


def test_shifts_are_resolved_over_a_cycle():
    s = fuse.resolve_shifts([(0, 1, (2, 0), 1), (1, 2, (0, 3), 1), (0, 2, (2, 3), 1)], [0, 1, 2, 9], axes=2)
    assert np.allclose(s[2], (2, 3)) and s[9] == (0, 0)
    assert fuse.resolve_shifts([], [4]) == {4: (0.0, 0.0, 0.0)}


@pytest.mark.parametrize("shift", [(0.5, -0.25), (1.75, 2.5)])
def test_shifts_below_a_voxel(shift):
    f = lambda y, x: sum(np.sin(2 * np.pi * (k * y + j * x) / 32 + k * j) for k in range(1, 6) for j in range(1, 6))
    y, x = np.mgrid[:32, :32].astype(float)
    a, b = f(y, x) + 50, f(y + shift[0], x + shift[1]) + 50
    got = phasecorr.shift_between(a, b, upsample=8)[:2]
    assert np.allclose(got, shift, atol=0.13)


def test_background_that_is_not_stored_is_left_out():
    rng = np.random.default_rng(5)
    thing = rng.integers(1, 999, (9, 9)).astype(float)
    a, b = np.zeros((64, 64)), np.zeros((64, 64))
    a[30:39, 30:39] = thing
    b[27:36, 32:41] = thing
    assert phasecorr.shift_between(a, b)[:2] == (3, -2)


def test_shortest_paths_span_the_tiles():
    grid = {(r, c): 3 * c + r for r in range(3) for c in range(3)}
    pairs = [(grid[a], grid[b], 10 - abs(a[0] - b[0]) * 8, 10 - abs(a[1] - b[1]) * 8) for a in grid for b in grid if grid[a] < grid[b] and 0 <= b[0] - a[0] <= 1 and 0 <= b[1] - a[1] <= 1]
    got = layout.shortest_paths(pairs + [(20, 21, 4, 4)])
    assert len(got) == 8 + 1 and (20, 21) in got
    assert not {(grid[0, 0], grid[1, 1]), (grid[1, 1], grid[2, 2])} & set(got)  # small overlaps cost more than a way round
    assert layout.large_overlaps([(0, 1, 10, 2), (0, 2, 2, 10), (0, 3, 2, 2)]) == [(0, 1), (0, 2)]
    assert layout.large_overlaps([(0, 1, 5, 5)]) == [(0, 1)] and layout.shortest_paths([]) == []


def test_an_affine_of_projections_is_lifted():
    a = np.array([[0.9, -0.1, 5.0], [0.1, 0.9, -3.0]])
    b = fuse.lifted(a)
    assert np.allclose(b @ [7, 2, 3, 1], [7, *(a @ [2, 3, 1]), 1])
    p = fuse.physical(b, (4.0, 2.0, 2.0))
    assert np.allclose(p @ [28, 4, 6, 1], [28, *(2 * (a @ [2, 3, 1])), 1])


def test_brightness_alone():
    rng = np.random.default_rng(6)
    flat = 1 + 0.2 * np.linspace(-1, 1, 16)[:, None] * np.ones(16)
    b = rng.uniform(100, 300, 9)
    planes = b[:, None, None] * flat + 7 + rng.normal(0, 1, (9, 16, 16))
    planes[:, 3:6, 3:6] += 2000
    assert np.abs(basic.brightness(planes, flat, 7.0) / b - 1).max() < 0.05


def test_archive_needs_one_top_level_entry(tmp_path):
    import tarfile

    for n in "ab":
        (tmp_path / n).write_text(n)
    with tarfile.open(tmp_path / "x.tar", "w") as t:
        t.add(tmp_path / "a", "a"), t.add(tmp_path / "b", "b")
    with pytest.raises(ValueError):
        storage.restore(str(tmp_path / "x.tar"), str(tmp_path))


def test_windows_tell_shifts_apart_that_slopes_hide():
    """A steep slope makes whole overlaps alike at any shift; windows see the stripes on it."""
    from voxloom.kernels import phasecorr as p

    rng = np.random.default_rng(7)
    y, x = np.mgrid[:64, :64]
    scene = 40 * x + 300 * ((y // 4) % 2) + rng.integers(0, 300, (64, 64)) + 100.0
    a, b = scene[:56], scene[8:]
    true, wrong = (8, 0), (0, 0)  # stripes repeat every 8 rows, so only the grain tells
    whole = [p.similarity(*p.overlap(a, b, d)) for d in (true, wrong)]
    windows = [p.structure(*p.overlap(a, b, d)) for d in (true, wrong)]
    assert whole[1] > 0.97 and windows[0] > 0.999 and windows[1] < 0.9
    assert p.shift_between(a, b)[:2] == true and p.shift_between(a, b)[2] > 0.999


def test_window_means_and_ranks():
    from voxloom.kernels import phasecorr as p

    a = np.random.default_rng(8).normal(size=(9, 4, 11))
    want = np.array([[[a[i : i + 5, :, k : k + 5].mean() for k in range(7)]] for i in range(5)])
    assert np.allclose(p.window_means(a, 5), want)
    assert p.ranks(np.array([3, 1, 3, 2])).tolist() == [3.5, 1, 3.5, 2]
    x = np.arange(1.0, 50)
    assert p.rank_correlation(x, x**3) == pytest.approx(1) and p.rank_correlation(x, -x + 99) == pytest.approx(-1)
    assert p.rank_correlation(x * 0, x * 0) == p.structure(x * 0, x * 0) == -1
