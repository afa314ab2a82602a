"""Golden identities on an 18-row extract of published back-fill output (BTC, 5-minute bars).

Fixed values below are the extract's columns in order:
close, sma_20, rsi_14, macd, macd_signal, bb_upper, bb_middle, bb_lower.
Only identities that 18 rows can support are checked: RSI where 14 changes
are inside the extract, macd_signal as the 9-row mean of macd, Bollinger
middle = SMA and symmetric bands.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlake.operators import indicators as ind

# Fixed values from the published extract (one tuple per row, time order).
EXTRACT = [
    (66452.28, 66267.0325, 60.474329929627508, 171.34096153845894, 231.8999857549837, 66579.908978931257, 66267.0325, 65954.156021068746),
    (66431.84, 66290.634, 57.929262860796541, 147.77833333333547, 220.487471509969, 66575.930065639681, 66290.634, 66005.33793436033),
    (66374.88, 66312.2815, 50.580903978994918, 133.83147435897263, 206.07809829059664, 66547.475210914388, 66312.2815, 66077.0877890856),
    (66178.2, 66323.708500000008, 36.646154766772476, 104.91410256411473, 188.0646581196585, 66499.401628197418, 66323.708500000008, 66148.0153718026),
    (66139.04, 66320.661000000007, 40.418440418440191, 67.1234615384601, 165.92658119658074, 66507.171222764853, 66320.661000000007, 66134.150777235162),
    (66026.92, 66304.4065, 33.233591029319896, 24.185320512828184, 140.66136752136742, 66531.632628990017, 66304.4065, 66077.180371009978),
    (65972.72, 66289.999, 25.084125203699585, -14.895000000004075, 114.08836182336219, 66561.144572235949, 66289.999, 66018.853427764043),
    (66087.25, 66279.9615, 34.464572795357242, -31.814871794864303, 87.6024572649589, 66565.879323768342, 66279.9615, 65994.043676231668),
    (65952.16, 66259.341, 31.077796144225061, -56.815000000002328, 60.627642450144371, 66577.2615077672, 66259.341, 65941.4204922328),
    (65975.43, 66235.813, 37.271064092110755, -79.120320512825856, 32.798611111112727, 66565.021030540913, 66235.813, 65906.604969459077),
    (66020.01, 66221.151, 39.006139121186763, -91.080512820524746, 6.258739316239371, 66561.760396903468, 66221.151, 65880.541603096528),
    (65918.6, 66199.3175, 36.038659425468133, -103.87506410256901, -20.153098290598589, 66559.166966473218, 66199.3175, 65839.468033526791),
    (66046, 66179.4355, 41.855593088215691, -129.46750000001339, -46.195498575501716, 66526.147021614161, 66179.4355, 65832.723978385853),
    (66195.03, 66168.9765, 47.1534635197567, -145.62589743589342, -69.834316239318767, 66499.374657015069, 66168.9765, 65838.57834298494),
    (66251.12, 66162.518, 41.829141483069733, -151.57576923078159, -89.363326210830962, 66480.334196506883, 66162.518, 65844.70180349311),
    (66216, 66161.7445, 41.336180597925392, -139.58000000000175, -103.2172150997196, 66478.928779857029, 66161.7445, 65844.560220142972),
    (66122.2, 66155.4825, 40.148774249890288, -133.63525641025626, -114.53059116809648, 66470.4808010731, 66155.4825, 65840.48419892689),
    (66225.43, 66155.194, 51.9860726810929, -112.09891025641991, -120.67324786325399, 66469.910752946627, 66155.194, 65840.477247053379),
]


@pytest.fixture(scope="module")
def frame(spark):
    t0 = dt.datetime(2026, 2, 13)
    rows = [("BTCUSDT", t0 + dt.timedelta(minutes=5 * i), *map(float, r)) for i, r in enumerate(EXTRACT)]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double, sma_20 double, "
                                       "rsi_14 double, macd double, macd_signal double, bb_upper double, "
                                       "bb_middle double, bb_lower double")


def test_rsi_with_full_history(frame):
    got = ind.rsi_steps(frame.select("symbol", "timestamp", "close"), ["symbol"])
    ours = [r["rsi_14"] for r in got.orderBy("timestamp").collect()]
    for i in range(14, 18):
        assert ours[i] == pytest.approx(EXTRACT[i][2], abs=1e-9)


def test_macd_signal_is_window_over_macd(frame):
    got = ind.macd_signal(frame.select("symbol", "timestamp", "macd"), ["symbol"])
    ours = [r["macd_signal"] for r in got.orderBy("timestamp").collect()]
    for i in range(8, 18):
        assert ours[i] == pytest.approx(EXTRACT[i][4], abs=1e-9)


def test_bollinger_identities(frame):
    for r in frame.collect():
        assert r["bb_middle"] == r["sma_20"]
        assert (r["bb_upper"] - r["bb_middle"]) == pytest.approx(r["bb_middle"] - r["bb_lower"], abs=1e-6)
