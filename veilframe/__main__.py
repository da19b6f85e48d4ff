from veilframe.plans.run import main

raise SystemExit(main())
