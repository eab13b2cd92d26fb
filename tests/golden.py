"""Published figures used as expected results. Fixed values."""

# month, revenue, cost of sales, operating expense
MONTHLY_PNL = [
    ('2023-01-01', 2696525.26, 686114.72, 2054322.62),
    ('2023-02-01', 2683708.03, 726109.62, 2088855.19),
    ('2023-03-01', 2776396.13, 830950.99, 2081445.25),
    ('2023-04-01', 2831027.96, 761296.9, 2126362.51),
    ('2023-05-01', 2832838.06, 760560.57, 2158202.76),
    ('2023-06-01', 2986125.25, 686843.91, 2178971.33),
    ('2023-07-01', 2960780.13, 798989.21, 2208756.14),
    ('2023-08-01', 2981399.56, 771557.06, 2264974.73),
    ('2023-09-01', 3132941.69, 780650.81, 2299848.25),
    ('2023-10-01', 3159434.59, 831734.39, 2262701.34),
    ('2023-11-01', 3224374.98, 777680.46, 2312439.24),
    ('2023-12-01', 3348723.55, 780775.39, 2294090.55),
    ('2024-01-01', 3374319.73, 783355.57, 2336480.49),
    ('2024-02-01', 3396187.59, 803392.72, 2334198.13),
    ('2024-03-01', 3497884.37, 802705.79, 2399886.76),
    ('2024-04-01', 3564305.42, 891848.52, 2425814.94),
    ('2024-05-01', 3553013.12, 901817.07, 2450450.83),
    ('2024-06-01', 3747503.25, 876587.9, 2473593.31),
    ('2024-07-01', 3623127.03, 879795.22, 2512458.26),
    ('2024-08-01', 3657801.07, 877649.27, 2535256.85),
    ('2024-09-01', 3946735.03, 981237.32, 2569272.57),
    ('2024-10-01', 3874182.66, 929149.39, 2608214.57),
    ('2024-11-01', 4006897.73, 943227.83, 2656389.19),
    ('2024-12-01', 4070781.23, 807695.87, 2652189.57),
    ('2025-01-01', 4106460.69, 930444.9, 2681888.43),
    ('2025-02-01', 4203447.74, 958897.56, 2696098.0),
    ('2025-03-01', 4169261.71, 1008183.44, 2770256.86),
    ('2025-04-01', 4251004.47, 1073185.71, 2830827.51),
    ('2025-05-01', 4269875.42, 1034274.69, 2859022.46),
    ('2025-06-01', 4386041.65, 1074815.75, 2860605.96),
    ('2025-07-01', 4396419.88, 1071556.4, 2911093.51),
    ('2025-08-01', 4439266.25, 1043257.43, 2946726.45),
    ('2025-09-01', 4535633.42, 1077604.45, 2958125.0),
    ('2025-10-01', 4531766.04, 1177672.76, 3007379.08),
    ('2025-11-01', 4600535.69, 1075809.35, 3029774.5),
    ('2025-12-01', 4646410.86, 1098676.46, 3071350.41),
    ('2026-01-01', 4676557.08, 1192184.24, 3092408.8),
    ('2026-02-01', 4742561.86, 1137167.33, 3140200.75),
    ('2026-03-01', 4767737.15, 1195482.52, 3168003.09),
    ('2026-04-01', 4880418.79, 1175565.65, 3213780.03),
    ('2026-05-01', 4880743.23, 1265006.82, 3240546.15),
    ('2026-06-01', 4915846.84, 1252275.21, 3272588.14),
    ('2026-07-01', 4864742.94, 1171411.22, 3334950.3),
    ('2026-08-01', 4987227.34, 1381276.22, 3406297.61),
    ('2026-09-01', 4972539.44, 1354546.53, 3404831.18),
    ('2026-10-01', 5000264.5, 1284002.81, 3471304.88),
    ('2026-11-01', 5102176.6, 1373756.48, 3527368.99),
    ('2026-12-01', 5284234.22, 1199222.98, 3567610.0),
]

# month, linear regression, naive, 3-month mean, linear trend
HOLDOUT = [
    ('2026-01-01', 4719521.412074686, 4646410.86, 4592904.196666666, 4744971.35942029),
    ('2026-02-01', 4796136.411293579, 4646410.86, 4592904.196666666, 4801739.528007247),
    ('2026-03-01', 4817908.484617667, 4646410.86, 4592904.196666666, 4858507.696594203),
    ('2026-04-01', 4865977.911155982, 4646410.86, 4592904.196666666, 4915275.86518116),
    ('2026-05-01', 4911015.751563052, 4646410.86, 4592904.196666666, 4972044.0337681165),
    ('2026-06-01', 4990952.507290195, 4646410.86, 4592904.196666666, 5028812.202355074),
]

# model, MAPE, RMSE, MAE
ACCURACY = [
    ('Linear Regression', 0.009241077587710833, 48303.131363174536, 44421.54761386601),
    ('Linear Trend (time-only)', 0.015829015086953765, 80346.98469688196, 76247.62255434816),
    ('Naive (last value)', 0.03382288034816513, 185805.00364527068, 164233.2983333332),
    ('Gradient Boosting', 0.039186732534959925, 209186.1900562553, 190038.0199779294),
    ('Moving Average (3mo)', 0.04494908408245588, 234438.9344899331, 217739.96166666722),
    ('Random Forest', 0.051303707863518455, 262729.99381583027, 248282.20279999418),
]

# month, recursive forecast
RECURSIVE = [
    ('2026-07-01', 5000090.302954236),
    ('2026-08-01', 5021301.157738734),
    ('2026-09-01', 5084956.1651973),
    ('2026-10-01', 5129165.45866661),
    ('2026-11-01', 5172565.719864184),
    ('2026-12-01', 5220640.98798766),
]

# month, line, forecast amount of all keys
FORECAST_TOTALS = [
    ('2026-07-01', 'Opex', 4510724.08),
    ('2026-07-01', 'Revenue', 4948890.63),
    ('2026-08-01', 'Opex', 4582828.99),
    ('2026-08-01', 'Revenue', 5029287.41),
    ('2026-09-01', 'Opex', 4621953.9),
    ('2026-09-01', 'Revenue', 5095687.19),
    ('2026-10-01', 'Opex', 4664860.81),
    ('2026-10-01', 'Revenue', 5169394.69),
    ('2026-11-01', 'Opex', 4708223.51),
    ('2026-11-01', 'Revenue', 5230859.5),
    ('2026-12-01', 'Opex', 4767166.83),
    ('2026-12-01', 'Revenue', 5306938.84),
]

# scenario, month, revenue, opex, EBITDA proxy
SCENARIO_PNL = [
    ('Base', '2026-07-01', 4948890.63, 4510724.08, 438166.55),
    ('Base', '2026-08-01', 5029287.41, 4582828.99, 446458.42),
    ('Base', '2026-09-01', 5095687.19, 4621953.9, 473733.29),
    ('Base', '2026-10-01', 5169394.69, 4664860.81, 504533.88),
    ('Base', '2026-11-01', 5230859.5, 4708223.51, 522635.99),
    ('Base', '2026-12-01', 5306938.84, 4767166.83, 539772.01),
    ('Upside', '2026-07-01', 5201284.05, 4578384.94, 622899.11),
    ('Upside', '2026-08-01', 5285781.07, 4651571.42, 634209.64),
    ('Upside', '2026-09-01', 5355567.24, 4691283.21, 664284.03),
    ('Upside', '2026-10-01', 5433033.82, 4734833.72, 698200.1),
    ('Upside', '2026-11-01', 5497633.33, 4778846.86, 718786.47),
    ('Upside', '2026-12-01', 5577592.72, 4838674.33, 738918.39),
    ('Downside', '2026-07-01', 4627212.74, 4420509.6, 206703.14),
    ('Downside', '2026-08-01', 4702383.73, 4491172.41, 211211.32),
    ('Downside', '2026-09-01', 4764467.52, 4529514.82, 234952.7),
    ('Downside', '2026-10-01', 4833384.04, 4571563.59, 261820.44),
    ('Downside', '2026-11-01', 4890853.63, 4614059.04, 276794.59),
    ('Downside', '2026-12-01', 4961987.82, 4671823.49, 290164.32),
]

# year, plan revenue, plan opex
LRP = [
    (2027, 144143122.0, 127186548.0),
    (2028, 171530315.0, 144992665.0),
    (2029, 200690469.0, 163841711.0),
]

# scenario, year, revenue, opex, margin
LRP_SCENARIOS = [
    ('Base', 2027, 144143122.0, 127186548.0, 0.117637),
    ('Base', 2028, 171530315.0, 144992665.0, 0.154711),
    ('Base', 2029, 200690469.0, 163841711.0, 0.18361),
    ('Upside', 2027, 166197019.67, 132909942.66, 0.200287),
    ('Upside', 2028, 197774453.19, 151517334.92, 0.233888),
    ('Upside', 2029, 231396110.76, 171214587.99, 0.26008),
    ('Downside', 2027, 116035213.21, 119555355.12, -0.030337),
    ('Downside', 2028, 138081903.57, 136293105.1, 0.012955),
    ('Downside', 2029, 161555827.54, 154011208.34, 0.0467),
]

# month, segment, customers, revenue, new, churned, revenue per customer, net new, churn rate
DRIVERS = [
    ('2023-01-01', 'PC10', 1233.2654464506059, 1056542.47, 54.4174701148112, 21.15202366420536, 856.7032126301579, 33.26544645060584, 0.017151233519986996),
    ('2023-01-01', 'PC20', 660.5256449557653, 762335.4, 32.87607047629645, 12.350425520531196, 1154.1344470449028, 20.52564495576525, 0.01869787435937978),
    ('2023-01-01', 'PC40', 301.8065461835569, 662768.06, 11.842583067913305, 10.036036884356427, 2196.0029309533547, 1.8065461835568772, 0.033253211407325046),
    ('2023-02-01', 'PC10', 1263.0296279692996, 1087940.59, 50.412164841156624, 20.64798332246309, 861.3737682062074, 29.764181518693533, 0.01634798017815381),
    ('2023-02-01', 'PC20', 669.0902570150238, 773475.96, 18.357067566924698, 9.79245550766619, 1156.0113929182987, 8.564612059258508, 0.014635477657906338),
    ('2023-02-01', 'PC40', 300.5024652220074, 656968.94, 8.176903983398038, 9.480984944947595, 2186.234776858285, -1.3040809615495572, 0.03155043982066225),
    ('2023-03-01', 'PC10', 1310.5749553015567, 1133867.86, 69.50992281232338, 21.964595480066347, 865.16826482397, 47.54532733225703, 0.016759511076581197),
    ('2023-03-01', 'PC20', 677.6204445474087, 787774.98, 20.819269141484178, 12.289081609099195, 1162.5608204990995, 8.530187532384982, 0.018135641726847878),
    ('2023-03-01', 'PC40', 298.9075610128735, 651780.55, 7.928211560639856, 9.52311576977376, 2180.5421976994717, -1.5949042091339036, 0.03185973528907693),
]

# month, expense, heads, expense per head
OPEX_PER_HEAD = [
    ('2023-01-01', 2740437.34, 160.0, 17127.733375),
    ('2023-02-01', 2814964.81, 161.2, 17462.560856079406),
    ('2023-03-01', 2912396.24, 163.3, 17834.637109614207),
    ('2023-04-01', 2887659.41, 164.5, 17554.160547112464),
    ('2023-05-01', 2918763.33, 166.7, 17509.07816436713),
    ('2023-06-01', 2865815.2399999998, 167.8, 17078.75589988081),
    ('2023-07-01', 3007745.35, 169.3, 17765.772888363852),
    ('2023-08-01', 3036531.79, 171.5, 17705.72472303207),
    ('2023-09-01', 3080499.06, 172.9, 17816.65159051475),
    ('2023-10-01', 3094435.73, 173.3, 17855.947663012117),
    ('2023-11-01', 3090119.7, 174.4, 17718.57626146789),
    ('2023-12-01', 3074865.94, 176.0, 17470.829204545455),
]

# month, line, budget, actual, variance, share
EXEC_VARIANCE = [
    ('2024-01-01', 'Opex', 3343333.52, 3119836.06, -223497.46, -0.06684868819189775),
    ('2024-01-01', 'Revenue', 3451552.33, 3374319.73, -77232.6, -0.022376192685451792),
    ('2024-02-01', 'Opex', 3434257.11, 3137590.85, -296666.26, -0.08638440585480794),
    ('2024-02-01', 'Revenue', 3435146.29, 3396187.59, -38958.7, -0.011341205500741625),
    ('2024-03-01', 'Opex', 3553123.35, 3202592.55, -350530.8, -0.0986542727259948),
    ('2024-03-01', 'Revenue', 3553787.04, 3497884.37, -55902.67, -0.015730450184769634),
    ('2024-04-01', 'Opex', 3522944.51, 3317663.46, -205281.05, -0.05826973698203377),
    ('2024-04-01', 'Revenue', 3623715.78, 3564305.42, -59410.36, -0.01639487299967006),
    ('2024-05-01', 'Opex', 3560891.24, 3352267.9, -208623.34, -0.058587394542272034),
    ('2024-05-01', 'Revenue', 3626032.71, 3553013.12, -73019.59, -0.020137598262316793),
    ('2024-06-01', 'Opex', 3496294.53, 3350181.21, -146113.32, -0.04179090712932581),
    ('2024-06-01', 'Revenue', 3822240.33, 3747503.25, -74737.08, -0.019553213180606065),
]

# quarter, cost centre, mean tone, variance share
LINK = [
    ('2024-Q1', 'CC100', 1.0, -0.09385289662487627),
    ('2024-Q1', 'CC200', -1.0, -0.031471425507662486),
    ('2024-Q1', 'CC300', 1.0, -0.1689210581938676),
    ('2024-Q1', 'CC400', 1.0, -0.03901681049064759),
    ('2024-Q1', 'CC500', 0.0, -0.12031152814337984),
    ('2024-Q2', 'CC100', 1.0, -0.07597703536442696),
    ('2024-Q2', 'CC200', 1.0, -0.05931229847249175),
    ('2024-Q2', 'CC300', 1.0, -0.11254438872629462),
    ('2024-Q2', 'CC400', 1.0, -0.03203072735856313),
    ('2024-Q2', 'CC500', 0.0, -0.02192558443178198),
    ('2024-Q3', 'CC100', 1.0, -0.10967198374652204),
    ('2024-Q3', 'CC200', 0.0, -0.059548265505227634),
    ('2024-Q3', 'CC300', 1.0, -0.1204315211776934),
    ('2024-Q3', 'CC400', 1.0, -0.033578208913716115),
    ('2024-Q3', 'CC500', 1.0, -0.05003847883884171),
    ('2024-Q4', 'CC100', 1.0, -0.053878553492094236),
    ('2024-Q4', 'CC200', 1.0, -0.043993685124028556),
    ('2024-Q4', 'CC300', 1.0, -0.13831895275971462),
    ('2024-Q4', 'CC400', -1.0, -0.03262776098977567),
    ('2024-Q4', 'CC500', 1.0, -0.07720227122530751),
    ('2025-Q1', 'CC100', 1.0, -0.036313081688701065),
    ('2025-Q1', 'CC200', 1.0, -0.02854025137495233),
    ('2025-Q1', 'CC300', 1.0, -0.07902167870363752),
    ('2025-Q1', 'CC400', 1.0, -0.014112110014626634),
    ('2025-Q1', 'CC500', 0.0, 0.015988302323264623),
    ('2025-Q2', 'CC100', 1.0, -0.03816531469566953),
    ('2025-Q2', 'CC200', -1.0, -0.000575647535436537),
    ('2025-Q2', 'CC300', 0.0, -0.10895525338544557),
    ('2025-Q2', 'CC400', 1.0, -0.020978954252547158),
    ('2025-Q2', 'CC500', 0.0, 0.004743795498950695),
    ('2025-Q3', 'CC100', 0.0, -0.052597284537589536),
    ('2025-Q3', 'CC200', 1.0, -0.0032530340032850486),
    ('2025-Q3', 'CC300', 0.0, -0.10131851521270917),
    ('2025-Q3', 'CC400', 1.0, -0.01472709113538205),
    ('2025-Q3', 'CC500', 0.0, -0.01718161166698178),
    ('2025-Q4', 'CC100', 1.0, -0.06438307713558136),
    ('2025-Q4', 'CC200', 0.0, -0.00904638304673947),
    ('2025-Q4', 'CC300', 0.0, -0.080387347460585),
    ('2025-Q4', 'CC400', 1.0, -0.03984124576371898),
    ('2025-Q4', 'CC500', 0.0, 0.04536268101603987),
    ('2026-Q1', 'CC100', 1.0, -0.026080892579861268),
    ('2026-Q1', 'CC200', 1.0, 0.028119586380381565),
    ('2026-Q1', 'CC300', 1.0, -0.0846112080686241),
    ('2026-Q1', 'CC400', 1.0, -0.04360361354713164),
    ('2026-Q1', 'CC500', 1.0, 0.04708329720969773),
    ('2026-Q2', 'CC100', 1.0, -0.028488306721832304),
    ('2026-Q2', 'CC200', 1.0, -0.008134570228978634),
    ('2026-Q2', 'CC300', 1.0, -0.05714354290605583),
    ('2026-Q2', 'CC400', 1.0, -0.027093535735529625),
    ('2026-Q2', 'CC500', 1.0, 0.0014133775255762949),
]

# topic, score of each comment
CLUSTERED = [
    (1, 1.0),
    (1, 1.0),
    (1, 0.0),
    (0, 1.0),
    (3, 0.0),
    (1, 1.0),
    (0, 1.0),
    (2, 1.0),
    (4, 1.0),
    (3, 1.0),
    (1, 1.0),
    (0, 1.0),
    (2, 1.0),
    (0, 1.0),
    (1, 0.0),
    (1, 1.0),
    (1, 1.0),
    (3, 0.0),
    (0, 1.0),
    (3, 0.0),
    (1, 1.0),
    (1, -1.0),
    (2, 1.0),
    (1, 1.0),
    (3, 0.0),
    (1, 1.0),
    (0, 1.0),
    (2, 1.0),
    (0, 1.0),
    (3, 0.0),
    (1, 1.0),
    (1, 0.0),
    (2, 1.0),
    (0, 1.0),
    (3, 1.0),
    (1, 1.0),
    (1, 1.0),
    (2, 1.0),
    (1, -1.0),
    (3, 1.0),
    (1, 1.0),
    (1, 1.0),
    (2, 1.0),
    (0, 1.0),
    (3, 0.0),
    (1, 1.0),
    (1, -1.0),
    (1, 0.0),
    (4, 1.0),
    (1, 0.0),
    (1, 0.0),
    (0, 1.0),
    (3, 0.0),
    (4, 1.0),
    (3, 0.0),
    (1, 1.0),
    (1, 0.0),
    (1, 0.0),
    (4, 1.0),
    (3, 0.0),
    (1, 1.0),
    (1, 1.0),
    (2, 1.0),
    (0, 1.0),
    (3, 1.0),
    (1, 1.0),
    (0, 1.0),
    (2, 1.0),
    (4, 1.0),
    (3, 1.0),
]

# topic, comments, mean score
CLUSTERS = [
    (0, 12, 1.0),
    (1, 30, 0.5333333333333333),
    (2, 9, 1.0),
    (3, 14, 0.35714285714285715),
    (4, 5, 1.0),
]
