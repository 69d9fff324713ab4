"""Expected index values of 27 zones. Id, disturbance count, fire count, built-up sum, index."""

ROWS = [
    (2, 0, 4, 0.0, 0.0547427882407267),
    (3, 0, 0, 0.0, 0.0),
    (4, 0, 4, 0.0, 0.0547427882407267),
    (5, 0, 7, 0.0, 0.07072930685657038),
    (7, 0, 33, 0.0, 0.11994424014006487),
    (8, 0, 6, 0.0, 0.06618742257917183),
    (9, 0, 27, 0.0, 0.1133402938168854),
    (10, 407, 120, 196.0, 0.9651627005769937),
    (11, 0, 9, 0.0, 0.0783192238595835),
    (14, 0, 40, 0.0, 0.1263119799115554),
    (15, 0, 9, 0.0, 0.0783192238595835),
    (16, 66, 66, 0.0, 0.376348121246714),
    (17, 0, 54, 0.0, 0.1363038550753665),
    (19, 0, 15, 0.0, 0.09430574247542715),
    (20, 62, 18, 0.0, 0.33006631220755833),
    (21, 952, 47, 0.0, 0.5000945614635607),
    (22, 128, 53, 0.0, 0.40536571182149234),
    (23, 235, 6, 0.0, 0.36939229894560527),
    (26, 0, 36, 0.0, 0.12282034188418776),
    (27, 392, 56, 0.0, 0.4690238734417405),
    (28, 339, 45, 0.0, 0.4536920706178978),
    (29, 157, 24, 0.0, 0.3904245870253672),
    (31, 0, 15, 0.0, 0.09430574247542715),
    (32, 0, 26, 0.0, 0.11210329906966379),
    (33, 0, 28, 0.0, 0.11453387616925505),
    (34, 0, 30, 0.0, 0.11680229035501402),
    (35, 0, 4, 0.0, 0.0547427882407267),
]
