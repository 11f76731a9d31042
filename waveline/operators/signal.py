"""Window conditioning in numpy, for Arrow UDFs: whole blocks of windows at a time.

Detrending, tapering and a zero-phase Butterworth band-pass, each over the last axis of an
array.
"""

from __future__ import annotations

import numpy as np

from waveline.functions.arrays import taper_weights

ORDER = 4
#: Samples that are filtered by one matrix product.
BLOCK = 64


def taper_vector(n: int, share: float = 0.05) -> np.ndarray:
    return np.array(taper_weights(n, share))


def detrend(x: np.ndarray, linear: bool = True) -> np.ndarray:
    """Less the mean, or the least-squares line."""
    x = np.asarray(x, np.float64)
    out = x - x.mean(axis=-1, keepdims=True)
    n = x.shape[-1]
    if linear and n > 1:
        i = np.arange(n) - (n - 1) / 2
        out = out - (out @ i)[..., None] * i / (i @ i)
    return out


def _bandpass(low: float, high: float, fs: float, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, float]:
    """Zeros, poles and gain of a digital Butterworth band-pass: analogue prototype, band transform, bilinear transform."""
    warped = 2 * fs * np.tan(np.pi * np.array([low, high]) / fs)
    width, centre = warped[1] - warped[0], np.sqrt(warped[0] * warped[1])
    k = np.arange(1, order + 1)
    prototype = np.exp(1j * np.pi * (2 * k + order - 1) / (2 * order))
    half = prototype * width / 2
    root = np.sqrt(half**2 - centre**2)
    poles = np.concatenate([half + root, half - root])
    digital = (2 * fs + poles) / (2 * fs - poles)
    zeros = np.concatenate([np.ones(order), -np.ones(order)])
    gain = np.real((2 * fs * width) ** order / np.prod(2 * fs - poles))
    return zeros, digital, float(gain)


def butter_bandpass(low: float, high: float, fs: float, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Its coefficients."""
    zeros, poles, gain = _bandpass(low, high, fs, order)
    return np.real(gain * np.poly(zeros)), np.real(np.poly(poles))


class Modal:
    """A band-pass as a sum of first-order parts, one for each pair of poles.

    Its state is a complex number a part, which a step multiplies by the pole: states can be
    carried over any number of samples by powers, without the loss of digits that powers of a
    companion matrix have.
    """

    def __init__(self, low: float, high: float, fs: float, order: int = ORDER):
        zeros, poles, gain = _bandpass(low, high, fs, order)
        self.pad = 3 * (len(poles) + 1)
        self.poles = poles[poles.imag > 0]
        of = lambda p: gain * np.prod(1 - zeros / p) / np.prod(1 - poles[poles != p] / p)
        self.weights = 2 * np.array([of(p) for p in self.poles])
        self.direct = float(np.real(gain * np.prod(zeros) / np.prod(poles)))
        #: The states after endless ones.
        self.steady = 1 / (1 - self.poles)
        n = np.arange(BLOCK)
        powers = self.poles[:, None] ** n
        response = np.real(self.weights @ powers)
        response[0] += self.direct
        lag = n[:, None] - n
        self._own = np.where(lag >= 0, response[np.maximum(lag, 0)], 0.0).T  # from sample to sample of a block
        self._to_state = powers[:, ::-1].T  # from sample to the state after a block
        self._from_state = self.weights[:, None] * powers * self.poles[:, None]

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of samples filtered from their states; and the states after the last sample."""
        rows, length = x.shape
        blocks = -(-length // BLOCK)
        wide = np.zeros((rows, blocks * BLOCK))
        wide[:, :length] = x
        wide = wide.reshape(rows, blocks, BLOCK)
        pushed = wide @ self._to_state
        states, z, step = np.empty((rows, blocks, len(self.poles)), complex), state, self.poles**BLOCK
        for k in range(blocks):
            states[:, k] = z
            z = z * step + pushed[:, k]
        # The last block's zeros are no samples: the state before them.
        z = z * self.poles ** (length - blocks * BLOCK)
        real = states.reshape(rows * blocks, -1)
        held = real.real @ self._from_state.real - real.imag @ self._from_state.imag
        return (wide @ self._own + held.reshape(rows, blocks, BLOCK)).reshape(rows, -1)[:, :length], z

    def both_ways(self, x: np.ndarray) -> np.ndarray:
        """Forward and backward over a whole segment, with an odd extension at both ends."""
        left, right = 2 * x[0] - x[self.pad : 0 : -1], 2 * x[-1] - x[-2 : -self.pad - 2 : -1]
        wide = np.concatenate([left, x, right])[None]
        for _ in range(2):
            wide = self.run(wide, wide[:, :1] * self.steady)[0][:, ::-1]
        return wide[0, self.pad : -self.pad]


def band(fs: float, low: float, high: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Coefficients with the high corner kept a hertz below Nyquist; None for no band at all."""
    top = high if fs / 2 > high else fs / 2 - 1.0
    return None if top <= low else butter_bandpass(low, top, fs)


def _steady(b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The filter's state after endless ones (direct form II transposed)."""
    n = len(a) - 1
    shift = np.eye(n, k=1)
    shift[:, 0] -= a[1:]
    return np.linalg.solve(np.eye(n) - shift, b[1:] - a[1:] * b[0])


def lfilter(b: np.ndarray, a: np.ndarray, x: np.ndarray, state: np.ndarray) -> np.ndarray:
    """One pass over the last axis, all rows at once, from the state given (rows by order).

    In state-space form, a block of samples at a time: what a block does by itself, and to the
    state, are two matrix products over all blocks; only the states follow one another.
    """
    n, size = len(a) - 1, BLOCK
    step = np.eye(n, k=1)
    step[:, 0] -= a[1:]
    into = b[1:] - a[1:] * b[0]
    powers = [np.eye(n)]
    for _ in range(size):
        powers.append(step @ powers[-1])
    from_state = np.stack([p[0] for p in powers[:size]])  # block sample by state
    response = np.concatenate([[b[0]], [p[0] @ into for p in powers[: size - 1]]])
    lag = np.arange(size)[:, None] - np.arange(size)
    own = np.where(lag >= 0, response[np.maximum(lag, 0)], 0.0)
    to_state = np.stack([powers[size - 1 - j] @ into for j in range(size)], axis=1)
    rows, length = x.shape
    blocks = -(-length // size)
    wide = np.zeros((rows, blocks * size))
    wide[:, :length] = x
    wide = wide.reshape(rows, blocks, size)
    pushed = wide @ to_state.T
    states = np.empty((rows, blocks, n))
    z = state
    for k in range(blocks):
        states[:, k] = z
        z = z @ powers[size].T + pushed[:, k]
    return (wide @ own.T + states @ from_state.T).reshape(rows, -1)[:, :length]


def filtfilt(b: np.ndarray, a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Forward and backward, with an odd extension at both ends and steady starting states."""
    x = np.asarray(x, np.float64)
    one = x.ndim == 1
    x = x[None] if one else x
    pad = 3 * max(len(a), len(b))
    if x.shape[-1] <= pad:
        raise ValueError(f"a window needs more than {pad} samples")
    left = 2 * x[:, :1] - x[:, pad:0:-1]
    right = 2 * x[:, -1:] - x[:, -2 : -pad - 2 : -1]
    wide = np.concatenate([left, x, right], axis=1)
    steady = _steady(b, a)
    for _ in range(2):
        wide = lfilter(b, a, wide, wide[:, :1] * steady)[:, ::-1]
    out = wide[:, pad:-pad]
    return out[0] if one else out


def clean_block(x: np.ndarray, fs: float, low: float, high: float, taper: np.ndarray | None = None) -> np.ndarray:
    """Conditioned windows: line off, mean off, taper on, band-pass."""
    x = detrend(detrend(x), linear=False)
    x = x * (taper_vector(x.shape[-1]) if taper is None else taper)
    coefficients = band(fs, low, high)
    return x if coefficients is None else filtfilt(*coefficients, x)


def clean_window(x: np.ndarray, fs: float, low: float, high: float) -> np.ndarray:
    return clean_block(np.asarray(x)[None], fs, low, high)[0]


def condition_segment(x: np.ndarray, fs: float, low: float = 2.0, high: float = 20.0) -> np.ndarray | None:
    """A whole segment, mean off and band-passed; None if it is too short for the filter."""
    f = Modal(low, high, fs)
    return f.both_ways(detrend(x, linear=False)) if len(x) > f.pad else None


def resample(x: np.ndarray, fs: float, to: float) -> np.ndarray:
    """Fourier resampling to another rate, periodic as that is; an approximation at the ends.

    A trace too short for one sample at the new rate has none.
    """
    n = len(x)
    m = int(round(n * to / fs))
    if not m:
        return np.empty(0)
    spectrum = np.fft.rfft(x)
    out = np.zeros(m // 2 + 1, complex)
    k = min(len(out), len(spectrum))
    out[:k] = spectrum[:k]
    return np.fft.irfft(out, m) * (m / n)


def strided_windows(data: np.ndarray, offset: int, n_windows: int, win: int, step: int) -> np.ndarray:
    """A view of windows, without copying."""
    return np.lib.stride_tricks.sliding_window_view(data[offset : offset + (n_windows - 1) * step + win], win)[::step]
